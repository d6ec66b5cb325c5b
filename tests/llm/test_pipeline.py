import pytest

import corpus_pipeline
from cartwheel.llm import common, queries, secret_scan
from tests.llm.test_ngram_join import brute
from tests.llm.test_packing import verify

SF = "/root/testdata/sf0.01"


def test_stages_one_by_one(spark):
    docs = common.read_table(spark, SF, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "ngram_jaccard_join", "secret_scan", "best_fit_packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {(r["doc_id"], r["text"]) for r in docs.collect()}
        docs = common.written(stage(spark, docs, SF), name)
        after = {(r["doc_id"], r["text"]) for r in docs.collect()}
        assert docs.columns == corpus_pipeline.COLUMNS and docs.count() == len(after)
        if name == "quality_classifier":
            assert after < before
        elif name == "exact_dedup":
            last = {}
            for k, t in before:
                last[t or ""] = max(k, last.get(t or "", k))
            assert after == {(k, t) for k, t in before if last[t or ""] == k}
        elif name == "ngram_jaccard_join":
            stay = {k for k, _, c in brute(sorted(before)) if k == c}
            assert after == {(k, t) for k, t in before if k in stay}
        else:
            assert {k for k, _ in after} == {k for k, _ in before}
            changed = dict(before - after)
            assert {k for k, t in before if secret_scan.spans(t or "")} == set(changed)
            assert not any(secret_scan.base_spans(t) for _, t in after - before)
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    verify(out, sorted(after))
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()} == {r["doc_id"] for r in out}


def test_every_operator_has_a_query():
    import __spark_entry__
    registered = __spark_entry__.queries()
    assert [n for n in range(1, 11) if not any(name.startswith(f"op{n}_") for name in registered)] == []
    assert registered["pipeline"] is corpus_pipeline.run and set(queries.ORACLES) <= set(registered)


class Cluster:
    """As much of a session as shared_dir looks at."""

    def __init__(self, master, named=None):
        self.sparkContext, self.conf, self.master, self.named = self, self, master, named

    def get(self, key, default=None):
        return self.named or default

    def getCheckpointDir(self):
        return None


def test_shared_folder_is_required_on_a_cluster():
    assert common.shared_dir(Cluster("spark://host:7077", "hdfs://shared/x/")) == "hdfs://shared/x"
    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError):
            common.shared_dir(Cluster(master))
