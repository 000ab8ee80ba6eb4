from brute import measures

from recordloom.llm import quality_rules as q
from recordloom.llm.queries import ORACLES, QUERIES


def test_measures(make_docs, sf, spark):
    texts = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    texts += [None, "", "\n\n a \n a \n a\n", "\n", "a b c d e f g h a b c d e f g h i", "a\r\na\r\n", "é é É"]
    got = {r["doc_id"]: r for r in q.ledger(make_docs(texts)).collect()}
    for k, text in enumerate(texts):
        want = measures(text)
        assert {m: got[k][m] for m in q.MEASURES} == want
        bits = sum(1 << i for i, rule in enumerate(q.RULES) if eval(rule.condition.replace(" OR ", " or "), {}, want))
        assert got[k]["failed"] == bits


def test_policies_and_ablation(make_docs):
    good = " ".join(f"word{k}" for k in range(30))
    book = q.ledger(make_docs([good, "short", "%%% " * 50, good.upper(), None]))
    assert sorted(r["doc_id"] for r in book.where(q.passes(2)).collect()) == [0]
    assert sorted(r["doc_id"] for r in book.where(q.passes(1)).collect()) == [0, 3]
    found = {r["rule"]: r for r in q.ablation(book, 2).collect()}
    assert found["capitals"]["n_failed_alone"] == 1 and found["capitals"]["n_kept_without"] == 2
    assert found["few_words"]["n_failed"] == 2 and found["symbols"]["n_kept"] == 1


def test_odd_rows(odd_docs, no_docs):
    assert q.ledger(odd_docs).count() == odd_docs.count() and q.ledger(no_docs).count() == 0
    kept = q.apply_policy(odd_docs, 2)
    assert kept.columns == odd_docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {4, 5, 6, 7, 8, None}
    assert q.apply_policy(no_docs, 2).count() == 0 and q.ablation(q.ledger(no_docs), 2).count() == 0


def test_oracle(spark, sf):
    from checks.compare import connect, oracle_rows, spark_rows

    name = "op8_quality_ledger"
    assert spark_rows(QUERIES[name](spark, sf)) == oracle_rows(connect(sf), ORACLES[name])
