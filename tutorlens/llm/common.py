"""Shared helpers of the corpus operators: reading, staging, labelled samples."""

from __future__ import annotations

import uuid
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tutorlens.session import shared_folder


#: A document of a training sample is long when it has more than one in so many characters of its class's bound.
LONG = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark only (any store Spark can open)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with null text as empty; extra columns cannot clash later."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts lineage (a lost executor re-reads the files) and gives the planner the
    true size, so that its broadcast threshold decides on joins with the table.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    write_table(df, path)
    back = read_back(spark, path, df.schema)
    back._staged_path = path
    return back


def write_table(df: DataFrame, path: str, compression: str = "snappy") -> None:
    """Write ``df`` as Parquet to a new folder."""
    df.write.option("compression", compression).parquet(path)


def read_back(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table that ``write_table`` wrote."""
    return spark.read.schema(schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a staged table that no later plan reads."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._staged_path)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def keep_judged(docs: DataFrame, key, judged: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, but those that ``judged`` sends away, and one of each repeated key.

    ``key(row)`` gives the named key columns of a struct column; judged has them,
    ``n`` (rows of the key) and ``stays``.  Keys that it does not hold stay.  The
    texts are shuffled by a key of their own, which no hot group shares.
    """
    keyed = key(F.col("row"))
    rows = docs.select(F.struct("*").alias("row")).select("row", *(c.alias(name) for name, c in keyed.items()))

    def same(a: DataFrame, b: DataFrame):
        tests = [a[name].eqNullSafe(b[name]) for name in keyed]
        return reduce(lambda x, y: x & y, tests)

    gone = judged.where("NOT stays").hint("merge")
    kept = rows.join(gone, same(rows, gone), "left_anti")
    again = judged.where("stays AND n > 1")
    if again.isEmpty():
        return kept.select("row.*")
    once = kept.join(again, same(kept, again), "left_anti")
    repeated = kept.join(again, same(kept, again), "left_semi").dropDuplicates(list(keyed))
    return once.unionByName(repeated).select("row.*")


def held_out(doc_id="doc_id"):
    """True where crc32(doc_id as text) mod 3 is 1; a null doc_id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: dict[int, int], max_chars: int
) -> tuple[list[str], list[int], dict[int, float]]:
    """Texts and labels of a bounded training sample, and each label's weight in it.

    Only rows of ``docs`` that are not held out count; null labels and null
    doc_ids do not.  A doc_id labelled twice takes its largest label, one with
    several texts the smallest text.  ``per_class`` bounds the documents of each
    class and ``max_chars`` the sum of their lengths, of which each class has its
    share and what others leave.  Documents are taken whole, by md5(doc_id); one
    that does not fit is skipped, and those longer than one in ``LONG`` of their
    class's characters come last, so that a few cannot fill the sample.  The
    weights restore the share that each label has among all labelled rows that
    count.  Raises ValueError when labelled rows exist but a class has none in
    the sample; without any labelled row, or without documents, it is empty.
    """
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where("doc_id IS NOT NULL AND label IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    rows = texts(docs).where(F.col("doc_id").isNotNull() & ~held_out())
    # the labelled documents of this input, each with its length
    sizes = rows.groupBy("doc_id").agg(F.max(F.length("text") + 1).cast("long").alias("size"))
    known = staged(marked.join(sizes, "doc_id").withColumn("rank_key", F.md5(F.col("doc_id").cast("string").cast("binary"))), "labelled")
    share = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    drawn, part = {}, {v: n / sum(per_class.values()) for v, n in per_class.items()}
    for value, n in per_class.items():
        fits = known.where((F.col("label") == value) & (F.col("size") <= max_chars))
        late = F.col("size") > max_chars * part[value] / LONG
        drawn[value] = fits.orderBy(late, "rank_key", "doc_id").limit(n).select("doc_id", "size", "rank_key").collect()
    discard(known)
    chosen, left, parts = [], max_chars, 1.0
    for value in sorted(drawn, key=lambda v: sum(r["size"] for r in drawn[v]) / part[v]):
        bound, used = left * part[value] / parts, 0
        for r in drawn[value]:
            if used + r["size"] <= bound:
                used += r["size"]
                chosen.append((r["rank_key"], r["doc_id"], value))
        left, parts = left - used, parts - part[value]
    found = [value for _, _, value in sorted(chosen)]
    if {*found} != {*per_class} and not docs.isEmpty() and not marked.isEmpty():
        raise ValueError(f"{label}: the training sample has no document of class {sorted({*per_class} - {*found})}; labelled rows that count: {share}")
    if not found:
        return [], [], {}
    # at most sum(per_class) ids: the bound of the broadcast
    ids = docs.sparkSession.createDataFrame([(i,) for _, i, _ in chosen], "doc_id long")
    got = rows.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).collect()
    text = {r["doc_id"]: r["text"] for r in got}
    weights = {v: n / sum(share.values()) / (found.count(v) / len(found)) for v, n in share.items() if v in found}
    return [text[i] for _, i, _ in sorted(chosen)], found, weights


def score_table(docs: DataFrame, score, fields: list[tuple[str, pa.DataType, str]]) -> DataFrame:
    """doc_id, held_out and ``fields`` (name, Arrow type, SQL type) for each row of ``docs``.

    ``score()`` gives a function from a list of texts to one column per field.
    """
    names = ["doc_id", *(name for name, _, _ in fields)]

    def run(batches):
        of = score()
        for batch in batches:
            columns = of([t.as_py() for t in batch.column(1)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, kind) for c, (_, kind, _) in zip(columns, fields))], names
            )

    scored = texts(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"{n} {kind}" for n, _, kind in fields))
    return scored.select("doc_id", held_out().alias("held_out"), *names[1:])


def keep_rows(docs: DataFrame, score, keep) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose columns of scores pass ``keep``."""
    at = docs.columns.index("text")

    def run(batches):
        of = score()
        for batch in batches:
            columns = of([t.as_py() or "" for t in batch.column(at)])
            yield batch.filter(pa.array(keep(columns), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
