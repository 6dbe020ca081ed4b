"""Registered queries for imperfect deliveries: corrupt lines, quarantine, batches of any age."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow.operators.merge import Ledger, ledger_run
from tierflow.plans.incremental import INCREMENTAL_COLUMNS, batches_of, in_batches, incremental_source
from tierflow.plans.models import PEDIDOS_ORDER
from tierflow.plans.registry import register
from tierflow.plans.stream_queries import _COLS, _CSV_ORACLE, CSV_COLUMNS, _Setup, csv_deliveries
from tierflow.plans.table_queries import _BASE, _bronze, _latest
from tierflow.session import work_dir
from tierflow.sources.storage import KeyedTable
from tierflow.streaming.changes import ATTEMPT, REASON, Quarantine
from tierflow.streaming.lines import CheckedPipe
from tierflow.streaming.pipe import DELIVERY, landing_folder, pipe_schema

# Which lines of the deliveries are broken, and how.
_REASON_SQL = """case when id % 23 = 0 then 'short' when id % 29 = 0 then 'long'
  when id % 31 = 0 then 'unbalanced quote' when id % 37 = 0 then 'value' end"""
_LINE_SQL = """
select *, """ + _REASON_SQL + """ as reason,
  case when id % 23 = 0 then head || quoted || '"'
       when id % 29 = 0 then head || quoted || '"' || tail || ',one,two'
       when id % 31 = 0 then head || quoted || tail
       when id % 37 = 0 then 'n' || head || quoted || '"' || tail
       else head || quoted || '"' || tail end as line
from (select *, cast(id as string) || ',' || cast(cliente_id as string) || ',' as head,
             '"' || replace(producto, '"', '""') as quoted,
             ',' || cantidad || ',' || coalesce(precio_unitario, '') || ',' || fecha_pedido || ',' || estado as tail
      from {csv_pedidos}) x"""
_LINE_ORACLE = _CSV_ORACLE + ", lines as (" + _LINE_SQL.format(csv_pedidos="csv_pedidos") + ")\n"


def _loaded_lines(spark, sf) -> CheckedPipe:
    """One delivery of raw lines per batch, loaded in two runs."""
    root = work_dir(spark, "pedidos_lines")
    pipe = CheckedPipe(spark, f"{root}/landing", f"{root}/loaded", f"{root}/_ck/lines")
    rows = spark.sql(_LINE_SQL, csv_pedidos=csv_deliveries(spark, sf))
    batches = batches_of(rows)
    for step in (batches[:2], batches[2:]):
        for b in step:
            # lines as they are, under the usual header: no separator, no quoting
            (rows.where(F.col("_batch_id").eqNullSafe(F.lit(b))).select(F.col("line").alias(",".join(CSV_COLUMNS)))
             .write.option("header", "true").option("sep", "\u0001").option("quote", "\u0000").option("escapeQuotes", "false")
             .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
             .option("compression", "gzip").csv(landing_folder(pipe.landing_root, b)))
        pipe.run()
    return pipe


@register("good_lines", _LINE_ORACLE + f"select {_COLS} from lines where reason is null")
def q_good_lines(spark, sf):
    """A4: the rows of deliveries with short, long, unbalanced and ill-typed lines."""
    return _loaded_lines(spark, sf).table().select(*CSV_COLUMNS)


@register("bad_lines", _LINE_ORACLE + "select _batch_id as delivery, reason, line from lines where reason is not null")
def q_bad_lines(spark, sf):
    """A4: the lines that are no rows, whole, with the reason."""
    bad = _loaded_lines(spark, sf).bad.read()
    return bad.select(F.col(DELIVERY).cast("int").alias("delivery"), F.col("_reason").alias("reason"), F.col("_line").alias("line"))


@register("line_report", _LINE_ORACLE + """
select _batch_id as delivery, count(*) as lines, count(*) filter (where reason = 'short') as short,
       count(*) filter (where reason = 'long') as long, count(*) filter (where reason = 'unbalanced quote') as unbalanced_quote,
       count(*) filter (where reason = 'value') as value
from lines group by 1""")
def q_line_report(spark, sf):
    """A4: lines and bad lines, counted per file and added up per delivery."""
    counts = ("lines", "short", "long", "unbalanced_quote", "value")
    files = _loaded_lines(spark, sf).report()
    return files.groupBy(F.col(DELIVERY).cast("int").alias("delivery")).agg(*[F.sum(c).cast("long").alias(c) for c in counts])


def _converted(date):
    def convert(rows):
        out = rows.withColumns({"cantidad": F.col("cantidad").try_cast("int"), "fecha_pedido": date})
        return out.withColumn(REASON, F.when(F.col("cantidad").isNull(), "quantity").when(F.col("fecha_pedido").isNull(), "date"))
    return convert


@register("stream_quarantine", _CSV_ORACLE + """, once as (
  select id, _batch_id, try_cast(cantidad as int) as cantidad, try_cast(fecha_pedido as date) as iso,
         coalesce(try_cast(fecha_pedido as date), cast(try_strptime(fecha_pedido, '%d/%m/%Y') as date)) as fecha_pedido
  from csv_pedidos)
select id, _batch_id as delivery, case when cantidad is null or iso is null then 2 else 1 end as attempt,
       case when cantidad is null then 'quantity' when fecha_pedido is null then 'date' end as reason,
       cantidad, case when cantidad is not null then fecha_pedido end as fecha_pedido
from once""")
def q_quarantine(spark, sf):
    """Rows that fail inside their micro-batch wait aside; a second attempt reads the other date format."""
    s = _Setup(spark, sf)
    target, aside = s.consumer(), Quarantine(spark, f"{s.root}/quarantine", pipe_schema())
    iso = F.col("fecha_pedido").try_cast("date")
    for step in (s.batches[:2], s.batches[2:]):
        s.land_and_load(*step)
        s.changes.consume_checked(target, aside, _converted(iso))
    either = F.coalesce(iso, F.try_to_timestamp(F.col("fecha_pedido"), F.lit("dd/MM/yyyy")).cast("date"))
    s.changes.retry(target, aside, _converted(either))
    place = [F.col(DELIVERY).cast("int").alias("delivery"), F.col(ATTEMPT).alias("attempt")]
    good = target.read().select("id", *place, F.lit(None).cast("string").alias("reason"), "cantidad", "fecha_pedido")
    left = aside.open().select("id", *place, F.col(REASON).alias("reason"), F.lit(None).cast("int").alias("cantidad"),
                               F.lit(None).cast("date").alias("fecha_pedido"))
    return good.unionByName(left)


@register("late_arrivals_ledger", _BASE + _latest("true"))
def q_late_arrivals_ledger(spark, sf):
    """The batches land newest first; the ledger takes each exactly once, however late."""
    b = incremental_source(_bronze(spark, sf))
    root = work_dir(spark, "pedidos_ledger")
    table, ledger = KeyedTable(spark, f"{root}/orders", "pedido_id"), Ledger(spark, f"{root}/ledger")
    order = batches_of(b)[::-1]
    for i in range(len(order)):
        if ledger_run(table, b.where(in_batches(order[:i + 1])), ledger, PEDIDOS_ORDER) != 1:
            raise AssertionError("a run took other batches than the one that landed")
    if ledger_run(table, b, ledger, PEDIDOS_ORDER) != 0:
        raise AssertionError("a batch was taken twice")
    return table.read().select(*INCREMENTAL_COLUMNS)
