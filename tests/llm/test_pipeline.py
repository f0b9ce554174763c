"""The stages one by one on whole tables, against plain versions of their decisions."""

import corpus_pipeline as P
import pytest

from test_line_dedup import brute
from test_near_dedup import brute_roots

from ledgerlens.llm import classifier, decontaminate
from ledgerlens.llm.near_dedup import near_duplicates

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(llm):
    """(stage, its input, its output) with every output stored and reread."""
    docs, out = llm.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in P.STAGES:
        after = P.cut(stage(llm, docs, SF), f"test-{name}")
        out.append((name, docs, after))
        docs = after
    return out


def test_order_and_columns(llm, stages):
    assert [s[0] for s in stages] == ["quality_classifier", "line_dedup", "simhash_near_dedup",
                                      "benchmark_decontamination", "bpe_encoding"]
    columns = llm.read.parquet(f"{SF}/documents.parquet").columns
    assert all(after.columns == columns for _, _, after in stages[:-1])
    assert "ids" in stages[-1][2].columns


def test_decisions(llm, stages):
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    by = {name: (before, after) for name, before, after in stages}
    before, after = by["quality_classifier"]
    model = classifier.train(before, llm.read.parquet(f"{SF}/labels.parquet"))
    assert ids(after) == ids(classifier.score(before, model).where("score >= 0.5"))
    before, after = by["line_dedup"]
    assert ids(before) == ids(after)
    assert after.where("n_chars <> length(text)").count() == 0
    kept = {r.doc_id: r.text for r in after.collect()}
    texts = {r.doc_id: r.text for r in before.collect()}
    assert kept == brute(texts) and sum(map(len, kept.values())) < sum(map(len, texts.values()))
    before, after = by["simhash_near_dedup"]
    found = near_duplicates(before).collect()
    roots = brute_roots([r.fp & (1 << 64) - 1 for r in found])
    smallest = {}
    for r, root in zip(found, roots):
        smallest[root] = min(r.doc_id, smallest.get(root, r.doc_id))
    assert ids(after) == sorted(smallest.values()) and len(smallest) < before.count()
    before, after = by["benchmark_decontamination"]
    items = [decontaminate.normal(r.text) for r in llm.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [r.doc_id for r in before.collect() if not any(i in decontaminate.normal(r.text) for i in items)]
    assert ids(after) == sorted(clean)
    before, after = by["bpe_encoding"]
    assert ids(before) == ids(after) and after.where("n_tokens <> size(ids)").count() == 0


def test_run_is_the_stages_in_turn(llm, stages):
    rows = lambda df: sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in df.collect())
    assert rows(P.run(llm, SF)) == rows(stages[-1][2])


def test_edge_rows_pass_all_stages(llm, edge):
    docs = edge.withColumnRenamed("fp", "n_chars").selectExpr("doc_id", "text", "'en' AS lang", "shard AS source",
                                                              "cast(n_chars AS bigint) AS n_chars")
    for name, stage in P.STAGES:
        docs = P.cut(stage(llm, docs, SF), f"edge-{name}")
    assert docs.count() >= 1
    empty = edge.limit(0).selectExpr("doc_id", "text", "'en' AS lang", "shard AS source", "cast(fp AS bigint) AS n_chars")
    for name, stage in P.STAGES:
        empty = P.cut(stage(llm, empty, SF), f"empty-{name}")
    assert empty.count() == 0
