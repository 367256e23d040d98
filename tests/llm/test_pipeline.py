"""The pipeline on sf0.001: every stage against brute force on its own input."""

import duckdb
import numpy as np

import corpus_pipeline as P
from tessera.llm import decontaminate, sentencepiece_stream, simhash_dedup, toxicity
from tessera.llm.common import fold, table, written
from test_decontaminate import brute
from test_simhash_dedup import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    for n, (name, stage) in enumerate(P.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        out = written(stage(spark, docs, SF), name)
        after = {r.doc_id: r for r in out.collect()}
        assert out.count() == len(after) and (n == 4 or out.columns == columns)
        if name == "toxicity":
            model = toxicity.fit(docs, table(spark, SF, "labels").filter(fold("doc_id", 3) != 1))
            want = {i for i, r in before.items() if model.scores([r.text])[0] < 0.7}
        elif name == "simhash_near_dedup":
            ids = sorted(before)
            want = {ids[g] for g in brute_components([brute_fingerprint(before[i].text) for i in ids], 2)}
        elif name == "benchmark_decontamination":
            items = duckdb.connect().execute(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
            want = set(before) - {i for i, _ in brute([(i, r.text) for i, r in before.items()], items)}
        else:
            want = set(before)
        assert set(after) == want, name
        if name == "secret_scan":
            assert all(after[i].n_chars == len(after[i].text) for i in after)
        elif n < 4:
            assert all(after[i] == before[i] for i in after)
        else:
            codec = sentencepiece_stream.Codec(P.PIECES)
            assert all(codec.decode(list(after[i].ids)) == before[i].text for i in after)
            assert all(np.frombuffer(codec.encode(before[i].text), "<u4").tolist() == list(after[i].ids) for i in after)
        docs = out
    assert 0 < docs.count() < table(spark, SF, "documents").count()
    assert (simhash_dedup, decontaminate) and P.ORACLE_SQL is None
