"""The pipeline against its stages by brute force."""

import sys

import pytest
from plain import components, cut_repeats, decontaminate, fingerprint, pieces, words

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

import corpus_pipeline  # noqa: E402
from ridgeline.llm.queries import PIECE_MODEL, table  # noqa: E402

SF = "/root/testdata/sf0.001"


def plain_run(docs, items, processor):
    """The ids that stay after each stage, and what the last one returns."""
    kept = [{d: t for d, t in docs.items() if t is not None and any(map(str.isalpha, t))}]
    named = components({d: fingerprint(t) for d, t in kept[-1].items()})
    kept.append({d: t for d, t in kept[-1].items() if named[d] == d})
    cut = cut_repeats(kept[-1])
    left = {}
    for d, t in kept[-1].items():
        n, gone, rest = cut[d]
        if not gone:
            left[d] = t
        elif gone < n:
            left[d] = rest
    kept.append(left)
    # A cut text is told by its words; white space between them is not part of the rule.
    texts = {d: t if isinstance(t, str) else " ".join(t) for d, t in left.items()}
    found = decontaminate(texts, items)
    kept.append({d: t for d, t in texts.items() if not found[d][4]})
    return kept, {d: pieces(processor, docs[d]) for d in kept[-1] if left[d] == docs[d]}


def check(spark, rows, sf_dir, monkeypatch=None):
    import sentencepiece

    docs = {r.doc_id: r.text for r in rows.collect()}
    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    want, tokens = plain_run(docs, items, sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL))
    at = rows
    for (name, stage), kept in zip(corpus_pipeline.STAGES, want):
        at = corpus_pipeline.materialize(stage(spark, at, sf_dir), "stage-test")
        assert at.columns == corpus_pipeline.COLUMNS, name
        got = {r.doc_id: r for r in at.collect()}
        assert set(got) == set(kept), name
        for d, t in kept.items():
            assert words(got[d].text) == (words(t) if isinstance(t, str) else t), name
    last = corpus_pipeline.STAGES[-1][1](spark, at, sf_dir).collect()
    assert {r.doc_id for r in last} == set(want[-1])
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in last}
    assert {d: got[d] for d in tokens} == tokens and all(len(r.ids) == r.n_tokens for r in last)
    return last


def test_stages_equal_brute_force(spark):
    made = check(spark, table(spark, SF, "documents"), SF)
    run = {(r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert run == {(r.doc_id, r.ids_sha256) for r in made}


def test_odd_documents(spark):
    line = " ".join(f"word{i}" for i in range(30))
    texts = [None, "", " \n", "123 !?", line, line, line + " more", "x " + line + "\nrest of it", "a " * 5000, "é", "same same", "SAME  same", "中文字"]
    rows = [(i, t, None if i % 3 else "en", "s", len(t or ""), "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row string")
    check(spark, docs, SF)


def test_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF)
        assert made.collect() == []


def test_order_and_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "SimHash near-dedup", "substring dedup", "benchmark decontamination", "SentencePiece encoding and decoding",
    ]
    import __spark_entry__ as e

    assert e.queries()["pipeline"].__wrapped__ is corpus_pipeline.run


@pytest.mark.parametrize("n", range(1, 11))
def test_each_operator_has_one_query(n):
    import __spark_entry__ as e

    assert len([k for k in e.queries() if k.startswith(f"op{n}_")]) == 1
