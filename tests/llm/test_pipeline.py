import hashlib

import public_tokenizers
import tiktoken

import corpus_pipeline
from tenure.llm import bpe, mixing
from tests.llm import test_line_dedup, test_mixing, test_simhash
from tests.llm.helpers import SF, edge_rows, frame, same


def test_stages_step_by_step(spark):
    """Each stage against brute force on its own input, all over the documents."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "mixing", "byte_bpe"]
    f = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    def take(df):
        assert df.columns == columns
        rows = df.collect()
        return spark.createDataFrame(rows, docs.schema), rows

    all_rows = docs.collect()
    docs, rows = take(f["toxicity"](spark, docs, SF))
    assert 0.85 * len(all_rows) <= len(rows) <= len(all_rows) and set(rows) <= set(all_rows)

    before = [(r.doc_id, r.text) for r in rows]
    docs, rows = take(f["line_dedup"](spark, docs, SF))
    same([(r.doc_id, r.text) for r in rows], [x[:2] for x in test_line_dedup.brute(before)])
    assert all(r.n_chars == len(r.text) for r in rows)

    groups = {c for *_, c in test_simhash.brute([(r.doc_id, r.text) for r in rows])}
    before = set(rows)
    docs, rows = take(f["near_dedup"](spark, docs, SF))
    assert sorted(r.doc_id for r in rows) == sorted(groups) and set(rows) <= before

    decided = {r.doc_id: r for r in mixing.mix(docs).collect()}
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + test_mixing.size(r.text)
    water = test_mixing.water(sizes)
    assert all(abs(d.target - water[d.source]) < 1e-6 for d in decided.values())
    before = {r.doc_id: r for r in rows}
    docs, rows = take(f["mixing"](spark, docs, SF))
    assert all(before[r.doc_id] == r for r in rows)
    assert sorted(r.doc_id for r in rows) == sorted(i for i, d in decided.items() for _ in range(d.copies))

    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    got = f["byte_bpe"](spark, docs, SF).collect()
    want = []
    for r in rows:
        ids = lib.encode_ordinary(r.text)
        want.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()))
    same(got, want)
    same(corpus_pipeline.run(spark, SF).collect(), want)


def test_edges(spark):
    df = frame(spark, edge_rows())
    for rows in (df, df.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, SF)
            if name != "byte_bpe":
                assert out.columns == df.columns
            n = out.count()
            assert (n > 0) == (rows is df)


def test_edges_with_nulls_only(spark):
    df = spark.createDataFrame([(None, None, None, None, None)] * 3, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:3] + corpus_pipeline.STAGES[4:]:
        assert stage(spark, df, SF).count() in (1, 3)
    assert mixing.mixed_rows(df).count() == 0
