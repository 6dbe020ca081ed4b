"""The sales mart kept up to date by deltas (I7, I8): a run reads what changed, not all of bronze.

Orders and customers are keyed tables whose merges log their change rows.  A run
takes the orders that changed, and those that didn't but whose customer did,
joins them to the dimension as it was and as it is, and writes what that takes
from and adds to each (city, product) as one partition of signed sums.  The mart
is their total.  A repeated run merges what it logged and replaces its own
partition, so nothing is added twice.

"Today" moves rows too: an order dated tomorrow counts from tomorrow on.  Given
the date of the run before, the orders and customers dated in between are
looked at again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions.scalar import as_of, clean_text, norm_key
from tierflow.operators.checks import CheckFailed, duplicate_keys
from tierflow.operators.dedup import latest_per_key
from tierflow.operators.merge import ChangeLog, image, merge_upsert
from tierflow.plans import models as M
from tierflow.session import empty_frame, stage
from tierflow.sources.storage import BatchTable, KeyedTable

EMAIL = "_email"
DELTA_SCHEMA = T.StructType([
    T.StructField("ciudad", T.StringType()), T.StructField("producto", T.StringType()), T.StructField("total_pedidos", T.LongType()),
    T.StructField("unidades_vendidas", T.LongType()), T.StructField("ingresos_totales", T.DecimalType(31, 2)), T.StructField("_run", T.IntegerType())])


class IncrementalMart:
    """Orders by id, customers by email, their change logs, and the mart's deltas."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.orders = KeyedTable(spark, f"{root}/orders", "pedido_id")
        self.customers = KeyedTable(spark, f"{root}/customers", EMAIL)
        self.order_log = ChangeLog(spark, f"{root}/order_changes")
        self.customer_log = ChangeLog(spark, f"{root}/customer_changes")
        self.deltas = BatchTable(spark, f"{root}/deltas", by=("_run",))

    # --- a run ------------------------------------------------------------------------

    def run(self, run: int, bronze_clientes: DataFrame, bronze_pedidos: DataFrame, as_of_date=None, previous_date=None) -> None:
        """Take one batch of bronze rows; runs are numbered in order of arrival."""
        people = bronze_clientes.where(F.col("email").like("%@%")).withColumn(EMAIL, norm_key("email"))
        merge_upsert(self.customers, latest_per_key(people, EMAIL, M.CLIENTES_ORDER), M.CLIENTES_ORDER, False, self.customer_log, run)
        merge_upsert(self.orders, latest_per_key(bronze_pedidos, "pedido_id", M.BRONZE_PEDIDOS_ORDER), M.BRONZE_PEDIDOS_ORDER, False,
                     self.order_log, run)
        delta = self._delta(run, as_of_date, as_of_date if previous_date is None else previous_date)
        self.deltas.write(delta.withColumn("_run", F.lit(run)))

    def _changes(self, table: KeyedTable, log: ChangeLog, run: int) -> tuple[DataFrame, DataFrame]:
        """A run's changed rows of a table, before and after."""
        schema = table.schema()
        if run not in log.batches():
            return empty_frame(self.spark, schema), empty_frame(self.spark, schema)
        rows = log.of(run)
        return tuple(image(rows, table.keys, schema.fieldNames(), side) for side in ("before", "after"))

    def _delta(self, run: int, today, before_today) -> DataFrame:
        was, now = self._changes(self.customers, self.customer_log, run)
        old, new = self._changes(self.orders, self.order_log, run)
        customers, orders = self.customers.read(), self.orders.read()
        changed = was.select(EMAIL).unionByName(now.select(EMAIL)).distinct()
        dim_now = dimension(customers, today)
        dim_was = dimension(customers.join(changed, EMAIL, "left_anti").unionByName(was), before_today)

        # customers that changed, or came of age between the two dates
        touched = was.unionByName(now)
        if str(today) != str(before_today):
            touched = touched.unionByName(customers.where(between_dates("fecha_registro", before_today, today)))
        touched = stage(touched.select("cliente_id").where("cliente_id IS NOT NULL").distinct(), "mart-touched")
        self._gate(dim_now, touched)
        same = orders.join(touched, "cliente_id", "left_semi")
        if str(today) != str(before_today):
            same = same.unionByName(orders.where(between_dates("fecha_pedido", before_today, today))).dropDuplicates(["pedido_id"])
        same = same.join(new.select("pedido_id"), "pedido_id", "left_anti")

        gone = sales(old.unionByName(same), dim_was, before_today)
        come = sales(new.unionByName(same), dim_now, today)
        both = gone.withColumn("_sign", F.lit(-1)).unionByName(come.withColumn("_sign", F.lit(1)))
        out = both.groupBy("ciudad", "producto").agg(
            F.sum("_sign").cast("bigint").alias("total_pedidos"), F.sum(F.col("_sign") * F.col("cantidad")).cast("bigint").alias("unidades_vendidas"),
            F.sum(F.when(F.col("_sign") < 0, -F.col("monto_total")).otherwise(F.col("monto_total"))).cast("decimal(31,2)").alias("ingresos_totales"))
        return out.where("total_pedidos <> 0 OR unidades_vendidas <> 0 OR ingresos_totales <> 0")

    def _gate(self, dim: DataFrame, touched: DataFrame) -> None:
        """The join must not multiply orders: a touched customer id stands for one customer."""
        if not duplicate_keys(dim.join(touched, "cliente_id", "left_semi"), "cliente_id").isEmpty():
            raise CheckFailed("cliente_id is not unique in the dimension; mart not updated")

    # --- the mart ----------------------------------------------------------------------

    def read(self, upto: int | None = None) -> DataFrame:
        """The mart, after run ``upto`` if given: one partial sum per run and group is added up."""
        rows = self.deltas.read(DELTA_SCHEMA) if self.deltas.exists() else empty_frame(self.spark, DELTA_SCHEMA)
        if upto is not None:
            rows = rows.where(F.col("_run") <= upto)
        out = rows.groupBy("ciudad", "producto").agg(
            F.sum("total_pedidos").alias("total_pedidos"), F.sum("unidades_vendidas").alias("unidades_vendidas"),
            F.sum("ingresos_totales").cast("decimal(31,2)").alias("ingresos_totales"))
        return out.where("total_pedidos > 0").withColumn("ticket_promedio", F.col("ingresos_totales").cast("double") / F.col("total_pedidos"))


def between_dates(col: str, after, upto):
    return (F.col(col) > as_of(after)) & (F.col(col) <= as_of(upto))


def dimension(customers: DataFrame, today) -> DataFrame:
    """City of each customer id, as silver and the dimension have it."""
    valid = F.col("fecha_registro").between(F.lit("2020-01-01").cast("date"), as_of(today))
    return customers.where(valid).select("cliente_id", clean_text("ciudad").alias("ciudad"))


def sales(orders: DataFrame, dim: DataFrame, today) -> DataFrame:
    """The fact rows of newest orders: those without a quality flag, with their customer's city."""
    clean = orders.where((F.col("fecha_pedido") <= as_of(today)) & (F.col("cantidad") > 0) & (F.col("precio_unitario") > 0))
    amount = (F.col("cantidad") * F.col("precio_unitario")).cast("decimal(21,2)")
    return clean.join(dim, "cliente_id").select("ciudad", clean_text("producto").alias("producto"), "cantidad", amount.alias("monto_total"))
