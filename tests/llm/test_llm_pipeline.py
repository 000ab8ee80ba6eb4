import pyarrow as pa
from brute import jaccard_components, measures

import corpus_pipeline
from recordloom.llm import decontamination, mixing, quality_rules


def test_stages_agree_with_brute_force(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns + (["shard", "slot"] if k == 4 else [])
        kept[name] = (before.collect(), docs.collect())
    before, after = kept["quality_rules"]
    rules = [next(r for r in quality_rules.RULES if r.name == n) for n in quality_rules.POLICIES[corpus_pipeline.POLICY]]
    good = [r for r in before if not any(eval(rule.condition.replace(" OR ", " or "), {}, measures(r["text"])) for rule in rules)]
    assert sorted(map(tuple, good)) == sorted(map(tuple, after))
    before, after = kept["ngram_jaccard_join"]
    found = jaccard_components([(r["doc_id"], r["text"]) for r in before], 5, 80)
    assert sorted(r["doc_id"] for r in after) == sorted(i for i, (_, c) in found.items() if i == c) and len(after) < len(before)
    before, after = kept["benchmark_decontamination"]
    items = [decontamination.folded(pa.array([r["text"]]))[0].tobytes() for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    held = {r["doc_id"] for r in before if any(i in decontamination.folded(pa.array([r["text"]]))[0].tobytes() for i in items)}
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before} - held
    before, after = kept["source_mixing"]
    sizes, taken, longest = {}, {}, max(len(r["text"].split()) for r in before)
    for rows, into in ((before, sizes), (after, taken)):
        for r in rows:
            into[r["source"]] = into.get(r["source"], 0) + len(r["text"].split())
    for p in mixing.plan(sizes):
        assert abs(taken.get(p["source"], 0) - p["target"]) <= 2 * longest
    before, after = kept["sharding"]
    assert sorted(tuple(r)[:5] for r in after) == sorted(map(tuple, before))
    assert len({(r["shard"], r["slot"]) for r in after}) == len(after)
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).select("doc_id", "shard").collect())) == sorted((r["doc_id"], r["shard"]) for r in after)


def test_odd_and_empty_documents(spark, sf, odd_docs, no_docs):
    plain = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for docs, more in ((plain, True), (no_docs, False)):
        for _, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, sf)
            assert set(docs.columns) <= set(found.columns) and bool(found.count()) == more
