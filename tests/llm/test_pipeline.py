"""The pipeline against its stages done by hand on collected rows."""

from collections import defaultdict

import corpus_pipeline
from pyspark.sql import functions as F
from test_exact_dedup import brute
from test_simhash import reach

from tutorlens.llm import quality_mil, simhash_near_dedup, toxicity_crf
from tutorlens.llm.common import staged, table


def test_stages(spark, sf001):
    docs = table(spark, sf001, "documents")
    labels = table(spark, sf001, "labels")
    names = docs.columns
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        after = staged(stage(spark, docs, sf001), "test")
        assert after.columns == names
        ids = [r["doc_id"] for r in after.collect()]
        if number == 0:
            model = quality_mil.fit(docs, labels)
            want = [i for i, s in zip(kept, model.scores(list(kept.values()))[0]) if s >= 0.5]
        elif number == 1:
            columns = toxicity_crf.fit(docs, labels).scorer()(list(kept.values()))
            want = [i for i, p in zip(kept, columns[1]) if not p]
        elif number == 2:
            want = [i for i, _, _, stays, _ in brute(list(kept.items())) if stays]
        else:
            order = sorted(kept)
            roots = reach([simhash_near_dedup.fingerprint(kept[i]) for i in order], 4)
            want = [i for i, r in zip(order, roots) if order[r] == i]
        assert sorted(ids) == sorted(want)
        docs, kept = after, {i: kept[i] for i in want}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf001).collect()
    assert {r["doc_id"] for r in packed} == set(kept)
    used = defaultdict(int)
    for r in packed:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 1024
    again = corpus_pipeline.run(spark, sf001)
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in again.collect()) == sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed)


def odd_table(spark, sf001, folder):
    """sf0.001 with repeated and null ids, odd texts and clashing columns in ``documents``."""
    docs = table(spark, sf001, "documents")
    some = docs.where("doc_id % 7 = 0")
    odd = docs.unionByName(some).unionByName(some.withColumn("doc_id", F.lit(None).cast("long")))
    odd = odd.unionByName(docs.where("doc_id % 11 = 0").withColumn("doc_id", F.col("doc_id") + 1)).unionByName(docs.limit(3).withColumn("text", F.lit(None).cast("string")))
    odd = odd.unionByName(docs.limit(1).withColumns({"text": F.lit("  \n" * 400_000 + "word " * 50_000), "doc_id": F.lit(10**12)}))
    odd = odd.withColumns({"sha": F.lit("x"), "fp": F.lit(1), "row": F.lit("r"), "stays": F.lit(True), "n": F.lit(2), "held_out": F.lit(1)})
    odd.write.parquet(f"{folder}/documents.parquet")
    table(spark, sf001, "labels").write.parquet(f"{folder}/labels.parquet")


def test_pipeline_of_an_odd_table(spark, sf001, tmp_path):
    odd_table(spark, sf001, tmp_path)
    docs = table(spark, str(tmp_path), "documents")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, staged(stage(spark, docs, str(tmp_path)), "test-odd")
        assert docs.columns == names
        assert docs.exceptAll(before).isEmpty()
        if name == "exact_dedup":
            white = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ")
            assert docs.count() == docs.select(white).distinct().count() == before.select(white).distinct().count()
        if name == "simhash_near_dedup":
            rows = [(r["doc_id"], simhash_near_dedup.fingerprint(r["text"] or "")) for r in before.collect()]
            of_fp = dict(zip((f for _, f in rows), reach([f for _, f in rows], 4)))
            kept = [of_fp[simhash_near_dedup.fingerprint(r["text"] or "")] for r in docs.collect()]
            assert sorted(kept) == sorted(set(of_fp.values()))  # one row of each component
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert sorted((r["doc_id"] for r in packed if r["piece"] == 0), key=repr) == sorted((r["doc_id"] for r in docs.collect()), key=repr)


def test_pipeline_of_nothing(spark, sf001, tmp_path):
    for name in ("documents", "labels"):
        table(spark, sf001, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
