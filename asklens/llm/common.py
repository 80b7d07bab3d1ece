"""Shared helpers of the training-data operators: names, row numbers, written tables, hot-safe joins, prefix sums."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from asklens.session import scratch_path

#: A group with more than 1 / HOT_SHARE of all rows is hot: at most HOT_SHARE groups can be.
HOT_SHARE = 1000


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def fresh_name(df: DataFrame, wanted: str) -> str:
    """A column name that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Hand this package to the executors' Python (as ``--py-files`` would), once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    to = Path(tempfile.mkdtemp(prefix="asklens-code-")) / "asklens_code.zip"
    with zipfile.ZipFile(to, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, str(f.relative_to(package.parent)))
    sc.addPyFile(str(to))  # Spark copies it to every executor
    _shipped.add(sc.applicationId)


def map_batches(df: DataFrame, run, schema: str) -> DataFrame:
    """``mapInArrow`` for a function of this package."""
    ship_code(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_groups(df: DataFrame, n_keys: int, n_order: int, run, names: list[str], schema: str) -> DataFrame:
    """``run(key, rows)`` for each group of equal first ``n_keys`` columns, rows sorted by the ``n_order`` columns after them.

    Groups must be bounded; thousands of small ones share a task without a call from Spark for each."""
    keys, order = df.columns[:n_keys], df.columns[n_keys:n_keys + n_order]
    dealt = df.repartition(*keys).sortWithinPartitions(*keys, *order)

    def go(batches):
        import pyarrow as pa

        key, held, out = None, [], []
        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns]):
                if row[:n_keys] != key:
                    if held:
                        out += run(key, held)
                    key, held = row[:n_keys], []
                held.append(row[n_keys:])
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema=to_arrow)
                out = []
        if held:
            out += run(key, held)
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema=to_arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    to_arrow = to_arrow_schema(StructType.fromDDL(schema))
    return map_batches(dealt, go, schema)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: inside another function's lambda an expression would be
    computed again for every element, a lambda variable is not."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


SPANS = "array<struct<start:int,end:int,value:string>>"


def match_spans(text: Column, pattern: str) -> Column:
    """(start, end, value) of all matches from left to right, in code points, end exclusive."""
    none = F.array().cast(SPANS)

    def locate(found: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        steps = let(gaps, lambda g: F.transform(found, lambda m, i: F.struct(F.length(F.get(g, i)).alias("gap"), m.alias("m"))))
        walked = F.aggregate(
            steps, F.struct(F.lit(0).alias("at"), none.alias("out")),
            lambda acc, x: F.struct(
                (acc["at"] + x["gap"] + F.length(x["m"])).alias("at"),
                F.concat(acc["out"], F.array(F.struct((acc["at"] + x["gap"]).alias("start"),
                                                      (acc["at"] + x["gap"] + F.length(x["m"])).alias("end"),
                                                      x["m"].alias("value")))).alias("out")),
            lambda acc: acc["out"])
        return F.when(F.size(found) > 0, walked).otherwise(none)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), locate)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder: lineage ends, and every
    later read sees the same rows, also after an executor is lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that tells rows apart, also where ids are null or repeated, and its name.

    The rows of a table that is read straight from Parquet files have one already: their file, as a 64-bit hash of its path, and
    their place in it, the same in every read.  Any other frame is written once, with numbers.  The files' metadata is asked
    for as such, so a column of its name may stand in the table."""
    row = fresh_name(docs, "row_no")
    plan = docs._jdf.queryExecution().analyzed()
    if plan.getClass().getSimpleName() == "LogicalRelation":
        relation = plan.relation()
        if (relation.getClass().getSimpleName() == "HadoopFsRelation"
                and relation.fileFormat().getClass().getSimpleName() == "ParquetFileFormat"):
            file = docs.metadataColumn("_metadata")
            place = F.concat_ws("#", F.hex(F.xxhash64(file["file_path"])), file["row_index"].cast("string"))
            return docs.withColumn(row, place), row
    return written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, how: str = "inner") -> DataFrame:
    """Inner or left join of many ``rows`` to one row a group, on null-safe ``keys`` that both have,
    where any group may hold a large share of the rows.

    ``groups`` should be a written table: it is read three times.  ``size`` is its column
    with a group's rows.  The groups above 1 / HOT_SHARE of all rows, at most HOT_SHARE by
    counting, are broadcast; their rows are dealt out at random by content in the shuffled
    join, which therefore sees small groups only."""
    rest = [c for c in groups.columns if c not in keys]
    total = groups.agg(F.sum(size).alias("total")).select("total").scalar()
    is_hot = F.coalesce(F.col(size) * HOT_SHARE > total, F.lit(False))
    packed = groups.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], is_hot.alias("__is_hot"),
        F.struct(*[F.col(c) for c in rest]).alias("__group"))
    hot = packed.where("__is_hot").select(*[F.col(f"__k{i}").alias(f"__h{i}") for i in range(len(keys))],
                                          F.col("__group").alias("__hot"))
    on_hot = [rows[k].eqNullSafe(hot[f"__h{i}"]) for i, k in enumerate(keys)]
    marked = rows.join(F.broadcast(hot), _all(on_hot), "left").drop(*[f"__h{i}" for i in range(len(keys))])
    # rows of hot groups need no partner: a spread-out number keeps them apart from each other
    spread = F.when(F.col("__hot").isNull(), F.lit(-1)).otherwise(
        F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in rows.columns if c not in keys]), F.lit(1 << 20)).cast("int"))
    marked = marked.withColumn("__spread", spread)
    cold = packed.where("NOT __is_hot").drop("__is_hot").withColumn("__cold_spread", F.lit(-1))
    on_cold = [marked[k].eqNullSafe(cold[f"__k{i}"]) for i, k in enumerate(keys)]
    joined = marked.join(cold, _all([*on_cold, marked["__spread"] == cold["__cold_spread"]]), "left")
    joined = joined.withColumn("__found", F.coalesce("__hot", "__group"))
    if how == "inner":
        joined = joined.where(F.col("__found").isNotNull())
    return joined.select(*map(quoted, rows.columns),
                         *[F.col("__found")[c].alias(c) for c in rest])


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def running_sums(rows: DataFrame, order: list[Column], values: list[str], name: str,
                 group: list[str] | None = None) -> DataFrame:
    """``rows`` (written in the given order) with ``before_<value>``: the sum of each value over the
    rows that come before, in the whole table or, with ``group``, in the same group.

    Rows are dealt by ranges of (group, order), so a large group is spread over many tasks.
    Each task sums its own rows, and the sums of the parts, one row a part and group, give
    the offsets.  Order columns must tell rows apart, or tied rows get one of the possible orders."""
    group = group or []
    sort = [*[F.col(g).asc_nulls_first() for g in group], *order]
    dealt = written(rows.repartitionByRange(*sort).withColumn("__part", F.spark_partition_id()), name)
    within = Window.partitionBy("__part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy("__part", *group).agg(*[F.sum(v).alias(f"__sum_{v}") for v in values])
    earlier = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        F.col("__part").alias("__o_part"), *[F.col(g).alias(f"__o_{g}") for g in group],
        *[F.coalesce(F.sum(f"__sum_{v}").over(earlier), F.lit(0)).alias(f"__off_{v}") for v in values])
    local = dealt.select("*", *[F.coalesce(F.sum(v).over(within), F.lit(0)).alias(f"__in_{v}") for v in values])
    on = [local["__part"] == offsets["__o_part"], *[local[g].eqNullSafe(offsets[f"__o_{g}"]) for g in group]]
    # both sides are keyed by (part, group), at most one range's rows each
    return local.join(offsets, _all(on)).select(
        *rows.columns, *[(F.col(f"__in_{v}") + F.col(f"__off_{v}")).alias(f"before_{v}") for v in values])


def running_offsets(parts: DataFrame, order: str, value: str) -> DataFrame:
    """(order, before): the sum of ``value`` over the rows with a smaller ``order``.

    For one row a task of a written table: as many rows as that table has parts, not as the data has."""
    ahead = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(order, F.coalesce(F.sum(value).over(ahead), F.lit(0)).cast("bigint").alias("before"))
