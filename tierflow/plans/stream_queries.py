"""Registered queries for file ingest and change streams.

Each query lands the orders overlay as CSV deliveries (one per load batch)
in a fresh folder under the shared work root, runs the pipe and the
consumers in steps, and returns the resulting table.  The oracle is the
batch equivalent over the same overlay.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow.plans.incremental import batches_of
from tierflow.plans.oracle import with_models
from tierflow.plans.registry import register
from tierflow.session import work_dir
from tierflow.sources.fixtures import raw_pedidos
from tierflow.sources.storage import KeyedTable
from tierflow.streaming.changes import CONSUMED_BATCH, ChangeStream, consumer_table
from tierflow.streaming.pipe import DELIVERY, FilePipe, pipe_schema, read_landing, write_landing

CSV_COLUMNS = ["id", "cliente_id", "producto", "cantidad", "precio_unitario", "fecha_pedido", "estado"]

# CSV deliveries derived from the orders overlay; some products carry an
# embedded quote or comma so that quoting is exercised.
CSV_PEDIDOS_SQL = """
select id, cliente_id,
  case when id % 11 = 0 then producto || ' 27"'
       when id % 19 = 0 then producto || ', pack'
       else producto end as producto,
  cantidad, precio_unitario, fecha_pedido, estado, _batch_id
from {raw_pedidos}"""

_CSV_ORACLE = (with_models("raw_pedidos").rstrip("\n")
               + ",\ncsv_pedidos as (" + CSV_PEDIDOS_SQL.format(raw_pedidos="raw_pedidos") + ")\n")
_COLS = ", ".join(CSV_COLUMNS)
_CSV_TIES = ", ".join(f"{c} nulls first" for c in CSV_COLUMNS[1:])
_LATEST_SQL = _CSV_ORACLE + f"""
select {_COLS} from (
  select *, row_number() over (partition by id order by _batch_id desc, {_CSV_TIES}) as rn from csv_pedidos) x
where rn = 1"""
# The deliveries after the first two.
_LATER = "_batch_id not in (select distinct _batch_id from csv_pedidos order by 1 limit 2)"


def csv_deliveries(spark, sf):
    return spark.sql(CSV_PEDIDOS_SQL, raw_pedidos=raw_pedidos(spark, sf))


class _Setup:
    """Landing folder, pipe and a change stream over the pipe's table, all fresh."""

    def __init__(self, spark, sf):
        self.spark = spark
        self.rows = csv_deliveries(spark, sf)
        root = work_dir(spark, "pedidos_pipe")
        self.landing = f"{root}/landing"
        self.pipe = FilePipe(spark, self.landing, f"{root}/pedidos_loaded", f"{root}/_ck/pipe")
        self.changes = ChangeStream(spark, self.pipe.target, pipe_schema(), f"{root}/_ck/changes")
        self.root = root
        self.batches = batches_of(self.rows)

    def land(self, *batches: int) -> None:
        for b in batches:
            write_landing(self.rows.filter(F.col("_batch_id").eqNullSafe(F.lit(b))).select(*CSV_COLUMNS), self.landing, b)

    def land_and_load(self, *batches: int) -> int:
        self.land(*batches)
        return self.pipe.run()

    def consumer(self):
        return consumer_table(self.spark, f"{self.root}/consumer")

    def current(self) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.root}/orders_current", "id")


@register("csv_ingest", _CSV_ORACLE + f"select {_COLS} from csv_pedidos")
def q_csv_ingest(spark, sf):
    s = _Setup(spark, sf)
    s.land(*s.batches)
    return read_landing(spark, s.landing).select(*CSV_COLUMNS)


@register("stream_file_ingest", _CSV_ORACLE + f"select {_COLS} from csv_pedidos")
def q_stream_file_ingest(spark, sf):
    """Deliveries arrive in three steps; a fourth run finds nothing and loads nothing."""
    s = _Setup(spark, sf)
    for step in (s.batches[:1], s.batches[1:3], s.batches[3:]):
        s.land_and_load(*step)
    if s.pipe.run() != 0:
        raise AssertionError("a pipe run with no new file loaded rows")
    return s.pipe.table().select(*CSV_COLUMNS)


@register("stream_consume_changes", _CSV_ORACLE + f"select {_COLS} from csv_pedidos where {_LATER}")
def q_consume_changes(spark, sf):
    """The rows the second consumption picked up: exactly those loaded since the first."""
    s = _Setup(spark, sf)
    target = s.consumer()
    s.land_and_load(*s.batches[:2])
    first = s.changes.consume_into(target)
    s.land_and_load(*s.batches[2:])
    s.changes.consume_into(target)
    return target.read().filter(F.col(CONSUMED_BATCH) >= first).select(*CSV_COLUMNS)


def _consumed_then_loaded(spark, sf):
    s = _Setup(spark, sf)
    target = s.consumer()
    s.land_and_load(*s.batches[:2])
    s.changes.consume_into(target)
    s.land_and_load(*s.batches[2:])
    return s, target


@register("peek_changes", _CSV_ORACLE + f"select {_COLS} from csv_pedidos where {_LATER}")
def q_peek_changes(spark, sf):
    """What is waiting after the first consumption, read without consuming it."""
    s, target = _consumed_then_loaded(spark, sf)
    return s.changes.pending(target).select(*CSV_COLUMNS)


_PEEK_ORDER = ["id", "cliente_id", "producto", "cantidad", "precio_unitario", "fecha_pedido", "estado"]


@register("peek_first_rows", _CSV_ORACLE + f"""
select {_COLS} from csv_pedidos where {_LATER}
order by {", ".join(c + " nulls first" for c in _PEEK_ORDER)} limit 5""")
def q_peek_first_rows(spark, sf):
    """the first five waiting rows in key order (a top-k, planned as TakeOrderedAndProject)."""
    s, target = _consumed_then_loaded(spark, sf)
    pending = s.changes.pending(target).select(*CSV_COLUMNS)
    return pending.orderBy(*[F.col(c).asc_nulls_first() for c in _PEEK_ORDER]).limit(5)


# Newest change of a key: the later delivery by number, then a fixed order of its values.
_NEWEST_DELIVERY = ["-" + DELIVERY, *CSV_COLUMNS[1:]]


@register("stream_merge_upsert", _LATEST_SQL)
def q_stream_merge(spark, sf):
    """Each consumption merges waiting changes into a keyed table."""
    s = _Setup(spark, sf)
    target = s.current()
    for step in (s.batches[:1], s.batches[1:3], s.batches[3:]):
        s.land_and_load(*step)
        s.changes.upsert_into(target, _NEWEST_DELIVERY)
    return target.read().select(*CSV_COLUMNS)


@register("stream_noop_rerun", _CSV_ORACLE + f"select {_COLS} from csv_pedidos")
def q_stream_noop(spark, sf):
    """After a full consumption nothing is waiting and a rerun processes no batch."""
    s = _Setup(spark, sf)
    target = s.consumer()
    s.land_and_load(*s.batches)
    s.changes.consume_into(target)
    if s.changes.has_data(target):
        raise AssertionError("data still waiting after a full consumption")
    if s.changes.consume_into(target) != 0:
        raise AssertionError("a rerun with nothing waiting processed a batch")
    if s.changes.consume_if_waiting(target) != 0:
        raise AssertionError("the gated run started with nothing waiting")
    return target.read().select(*CSV_COLUMNS)


@register("stream_retry_after_error", _LATEST_SQL)
def q_stream_retry(spark, sf):
    """All changes are consumed again from a lost checkpoint; the merge leaves one row per key, the newest."""
    s = _Setup(spark, sf)
    target = s.current()
    s.land_and_load(*s.batches)
    s.changes.upsert_into(target, _NEWEST_DELIVERY)
    replay = ChangeStream(spark, s.pipe.target, pipe_schema(), f"{s.root}/_ck/replay", max_files_per_trigger=1)
    replay.upsert_into(target, _NEWEST_DELIVERY)
    return target.read().select(*CSV_COLUMNS)
