"""The pipeline against its stages by brute force, and its stages on odd rows."""

import hashlib

import corpus_pipeline
import public_tokenizers
from conftest import SF_SMALL
from oracle_compare import duck
from test_near_dedup import brute
from tokenizers import Tokenizer

from servicelens.llm.oracle import ORACLE


def test_pipeline_equals_brute_force(spark):
    con = duck(SF_SMALL)
    texts = dict(con.sql("SELECT doc_id, text FROM documents").fetchall())
    kept = {i for (i,) in con.sql(f"SELECT doc_id FROM ({ORACLE['op7_quality_rules']}) WHERE kept").fetchall()}
    groups = brute([(i, texts[i]) for i in sorted(kept)], 5)
    single = {i for i, (n, least) in groups.items() if i == least or not n}
    con.execute("CREATE TABLE single AS SELECT unnest(?) AS id", [sorted(single)])
    con.execute("CREATE OR REPLACE VIEW documents AS " f"SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet') WHERE doc_id IN (SELECT id FROM single)")
    leaked = {i for (i,) in con.sql(f"SELECT doc_id FROM ({ORACLE['op9_decontamination']})").fetchall()}
    assert kept < set(texts) and single < kept and leaked
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for i in single - leaked:
        ids = library.encode(texts[i] or "", add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((texts[i] or "").encode()).hexdigest())
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert len(got) == len(want)
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want


def test_stages_on_odd_and_empty_tables(spark):
    schema = "doc_id long, text string, quality string, node string, kept string"
    rows = [(1, None), (None, "short"), (2, "One sentence of words that all differ. " * 1), (2, "One sentence of words that all differ. ")]
    for odd in ([], [(i, t, "q", "n", "k") for i, t in rows]):
        docs = spark.createDataFrame(odd, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_SMALL)
            assert out.columns == docs.columns and out.count() <= len(odd)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() == len(odd)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "bpe"]
