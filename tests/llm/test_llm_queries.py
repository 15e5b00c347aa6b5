"""Registered queries over the smallest tables: check SQL, held-out quality, the pipeline against plain stages."""

from pathlib import Path

import corpus_pipeline
import harness
import plain
import pytest

from sensorqc.llm import pii, queries
from sensorqc.llm.base import table

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_check_sql(spark, name):
    got = queries.QUERIES[name](spark, DATA).toPandas()
    assert harness.compare(got, harness.duck(DATA).execute(queries.ORACLES[name]).df()) is None


def rows_of(spark):
    return [(r.doc_id, r.text) for r in table(spark, DATA, "documents").select("doc_id", "text").collect()]


def test_ngram_join_query(spark):
    rows = rows_of(spark)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.QUERIES["op6_ngram_jaccard_join"](spark, DATA).collect()}
    assert got == {d: x for (d, _), x in zip(rows, plain.components(rows, 4, 85), strict=True)}


def test_suffix_query(spark):
    rows = rows_of(spark)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.QUERIES["op7_suffix_array_dedup"](spark, DATA).collect()}
    assert got == {d: x for (d, _), x in zip(rows, plain.cut_substrings(rows, 50), strict=True)}


def test_pii_query_leaves_no_entity(spark):
    source = dict(rows_of(spark))
    for r in queries.QUERIES["op2_pii_surrogates"](spark, DATA).collect():
        found = pii.find_entities(source[r.doc_id] or "")
        assert r.n_entities == len(found) and not any(source[r.doc_id][s:e] in r.text for s, e, *_ in found)
        assert found or r.text == source[r.doc_id]


def test_sentencepiece_query_round_trip(spark):
    assert all(r.round_trip for r in queries.QUERIES["op4_sentencepiece"](spark, DATA).collect())


def test_sentencepiece_scores_reach_the_library(tmp_path):
    spm = pytest.importorskip("sentencepiece")
    from sensorqc.llm import unigram

    path = Path(queries.tokenizer_file(queries.PIECE_MODEL))
    raw = path.read_bytes()
    at = raw.rfind(b"\x18\x02")  # model type of the trainer settings: merges; the library then segments by unigram
    patched = tmp_path / "unigram.model"
    patched.write_bytes(raw[:at] + b"\x18\x01" + raw[at + 2 :])
    try:
        library = spm.SentencePieceProcessor(model_file=str(patched))
    except (OSError, RuntimeError):
        pytest.skip("the model file can't be switched")
    model = unigram.Model.load(str(path))
    texts = ["the quick brown fox", "naïve café", "日本語 🙂", "a  b", "unbelievable segmentation"]
    for text, mine in zip(texts, unigram.Encoder(model)(texts), strict=True):
        import numpy as np

        ids, theirs = np.frombuffer(mine, "<i4").tolist(), library.encode(text)
        score = lambda x: sum(model.scores[i] if model.types[i] == unigram.NORMAL else 0 for i in x)
        assert score(ids) >= score(theirs) - 1e-6


def test_toxicity_query_on_the_held_out_fold(spark):
    truth = {r.doc_id: r.toxic for r in table(spark, DATA, "labels").collect()}
    rows = [r for r in queries.QUERIES["op8_toxicity"](spark, DATA).collect() if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in rows) >= 0.9 * len(rows)


def test_pipeline_stages(spark):
    docs = table(spark, DATA, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        seen[name] = (docs, out)
        if name != "packing":
            assert out.columns == docs.columns
        docs = corpus_pipeline.materialise(out, name)
    text = lambda df: {r.doc_id: r.text for r in df.collect()}
    before, after = (text(x) for x in seen["line_dedup"])
    want = plain.cut_lines(sorted(before.items()), 50)
    assert after == {d: t for d, t in want.items() if t == before[d] or plain.words(t)}
    before, after = (text(x) for x in seen["ngram_join"])
    rows = sorted(before.items())
    assert set(after) == {d for (d, _), (n, c) in zip(rows, plain.components(rows, 5, 80), strict=True) if n == 0 or c == d}
    before, after = (text(x) for x in seen["pii"])
    assert set(before) == set(after)
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == set(after)


def test_toxicity_query_has_active_swaps(spark):
    """The registered query's model holds the names of groups in every language, and swaps hardly move its scores."""
    from sensorqc.llm import toxicity

    model = toxicity.fit(table(spark, DATA, "documents"), table(spark, DATA, "labels"))
    assert all(t in model["weights"] for t in toxicity.KIND_OF)
    score = toxicity.Scorer(model)
    for terms in toxicity.IDENTITY_TERMS.values():
        scores = [score(f"the {t} of the town".encode()) for t in terms]
        assert max(scores) < 0.5 and max(scores) - min(scores) < 0.1
