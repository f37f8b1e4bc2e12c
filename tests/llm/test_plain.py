"""Operators against brute force and SQL, and the cases every operator must bear."""

import zlib

import pytest
from oracle import connect, differences
from plain import components, cut_repeats, decontaminate, edited, fingerprint, pieces, sha, syncmers, words
from pyspark.sql import functions as F

from ridgeline.llm import decontaminate as clean
from ridgeline.llm import language, simhash, substrings
from ridgeline.llm import pieces as tokens
from ridgeline.llm import syncmers as anchors
from ridgeline.llm.queries import ORACLES, PIECE_MODEL, QUERIES, table

SF = "/root/testdata/sf0.001"

LINE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
ODD = {
    1: "alpha beta gamma",
    2: "ALPHA  beta\tgamma",
    3: "",
    4: " \n\t ",
    5: LINE,
    6: "before " + LINE + " after",
    7: LINE + "\n" + LINE,
    8: "a " * 60,
    9: "▁ marks ▁▁ and  spaces     é 中文字 \U0001f600 \x00 end ",
    10: "word " * 30_000 + LINE,
    11: LINE.upper(),
    12: "x",
    13: None,
    14: "x" * 5000 + " y",
    15: LINE + " " + LINE.split()[0],
}


@pytest.fixture(scope="module")
def odd(df):
    return df([(k, v, "clash", 0) for k, v in ODD.items()], "doc_id long, text string, n_words string, fp int")


@pytest.fixture(scope="module")
def df(spark):
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}


@pytest.fixture(scope="module")
def processor():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) == []


def test_simhash_query(spark, documents):
    prints = {d: fingerprint(t) for d, t in documents.items()}
    named = components(prints)
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in QUERIES["op1_simhash"](spark, SF).collect()}
    assert got == {(d, f"{prints[d]:016x}", named[d]) for d in documents}


def test_simhash_odd(spark, odd):
    prints = {d: fingerprint(t) for d, t in ODD.items()}
    named = components(prints)
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_copies(odd).collect()}
    assert got == {(d, f"{prints[d]:016x}", named[d]) for d in ODD}
    assert named[4] == 3 and named[2] == 1 and named[13] == 3


def test_simhash_null_and_repeated_ids(df):
    rows = [(None, "some words here"), (7, "some words here"), (7, "some words here"), (None, "nothing like it")]
    got = [(r.doc_id, r.component_id) for r in simhash.near_copies(df(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=str) == sorted([(None, 7), (7, 7), (7, 7), (None, None)], key=str)


@pytest.mark.parametrize("size", [1, 2, 70, 5000])
def test_block_links_connect_what_brute_force_connects(size):
    import random

    draw = random.Random(size)
    bits = [draw.getrandbits(64)]
    while len(bits) < size:
        b = draw.choice(bits)
        for _ in range(draw.randrange(1, 6)):
            b ^= 1 << draw.randrange(16)
        bits.append(b)
    bits = list(dict.fromkeys(bits))
    want = components(dict(enumerate(bits)))
    links = simhash.block_links(bits)
    assert all((bits[a] ^ bits[b]).bit_count() <= 2 for a, b in links)
    parent = list(range(len(bits)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert {i: find(i) for i in range(len(bits))} == want


def test_components_of_a_chain(df):
    from ridgeline.llm.graph import components as connect_all

    links = [(i, i + 1) for i in range(1, 300)] + [(1000, 999), (1000, 1001)] + [(5000, i) for i in range(5001, 5200)]
    got = {r.node: r.component for r in connect_all(df(links, "a long, b long")).collect()}
    assert {got[i] for i in range(1, 301)} == {1} and {got[i] for i in (999, 1000, 1001)} == {999}
    assert {got[i] for i in range(5000, 5200)} == {5000} and len(got) == 300 + 3 + 200


def test_substrings_odd(odd):
    want = cut_repeats(ODD)
    for bits in (None, 4):
        made = substrings.repeated_words(odd, bits=bits).collect()
        assert {r.row.doc_id: (r.n_words, r.n_removed, words(r.kept)) for r in made} == want
    assert {r.row.doc_id: r.cut_text for r in made if not r.n_removed} == {d: ODD[d] for d in ODD if not want[d][1]}


def test_substrings_carry_any_columns(odd):
    made = substrings.repeated_words(odd, carry=["doc_id", "n_words", "fp"])
    assert made.where("row.n_words = 'clash' and row.fp = 0").count() == len(ODD)


def test_substrings_null_and_repeated_ids(df):
    rows = [(None, LINE), (3, LINE), (3, LINE), (2, "short")]
    made = substrings.repeated_words(df(rows, "doc_id long, text string")).collect()
    assert sorted(((r.row.doc_id, r.n_removed) for r in made), key=str) == [(2, 0), (3, 0), (3, 0), (None, 20)]


def test_rows_without_an_id_keep_their_own_windows(df, monkeypatch):
    """Many rows without an id: each is handed the windows of its own text, not those of all."""
    texts = [" ".join(f"w{(i * 7 + j * (i + 3)) % 997}" for j in range(40)) for i in range(300)]
    handed = []
    inner = substrings.map_texts

    def spying(joined, *args, **more):
        handed.append(joined)
        return inner(joined, *args, **more)

    monkeypatch.setattr(substrings, "map_texts", spying)
    rows = [(None, t) for t in texts + texts[:5]]
    made = substrings.repeated_words(df(rows, "doc_id long, text string"), bits=4).collect()
    assert len(made) == 305
    longest = handed[0].selectExpr("max(size(owned))").first()[0]
    assert 0 < longest <= 21


def test_decontaminate_odd(spark, odd, df):
    items = [(1, "Alpha, beta; GAMMA!"), (2, LINE + " and more"), (2, "x"), (3, None), (4, "..."), (5, "中文字"), (None, "alpha")]
    want = decontaminate(ODD, [i for i in items if i[0] is not None])
    bench = df(items, "item_id long, text string")
    for limit in (64 << 20, 1):
        made = clean.scan(odd, bench, max_pattern_bytes=limit).collect()
        got = {r.row.doc_id: (r.n_words, r.n_hit, r.n_items, sha(",".join(r["items"])), r.contaminated) for r in made}
        assert got == want
        for r in made:
            held = (ODD[r.row.doc_id] or "").encode()
            assert sum(len(held[s.start : s.end].decode().split()) for s in r.spans) >= (r.n_hit > 0)
    assert clean.scan(odd, bench.limit(0)).where("n_hit > 0 or contaminated").count() == 0


def test_decontaminate_items_without_an_id(spark, df, odd, tmp_path):
    import os

    for name in os.listdir(SF):
        if name not in ("documents.parquet", "benchmark.parquet"):
            os.symlink(f"{SF}/{name}", tmp_path / name)
    items = [(1, "alpha beta gamma"), (None, "alpha"), (None, "seven eight nine"), (None, None), (2, "...")]
    odd.select("doc_id", "text").where(r"text is null or not contains(text, chr(0))").write.parquet(str(tmp_path / "d"))
    df(items, "item_id long, text string").write.parquet(str(tmp_path / "b"))
    for name in ("documents", "benchmark"):
        os.symlink(tmp_path / name[0], tmp_path / f"{name}.parquet")
    con = connect(SF)
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name[0]}/*.parquet')")
    assert differences(QUERIES["op6_decontaminate"](spark, str(tmp_path)), con, ORACLES["op6_decontaminate"]) == []
    bench = df(items, "item_id long, text string")
    for limit in (64 << 20, 1):
        made = {r.row.doc_id: r for r in clean.scan(odd, bench, max_pattern_bytes=limit, unnamed=True).collect()}
        assert made[1]["items"] == ["1", None] and made[1].n_items == 2 and made[1].contaminated
        assert made[5]["items"] == [None] and made[5].n_hit == 3 and made[12]["items"] == []


def test_pieces(spark, odd, documents, processor):
    made = tokens.encode(odd, PIECE_MODEL).collect()
    got = {r.row.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in made}
    assert got == {d: pieces(processor, t) for d, t in ODD.items()}
    for r in made:
        assert r.decoded == processor.decode(r.ids)
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op3_sentencepiece"](spark, SF).collect()}
    assert got == {d: pieces(processor, t) for d, t in documents.items()}


def test_pieces_with_a_small_table(monkeypatch, processor):
    monkeypatch.setattr(tokens, "TABLE_CHUNKS", 3)
    table_of = tokens.ChunkTable(PIECE_MODEL)
    for text in [t for t in ODD.values() if t]:
        ids, decoded = table_of.encode(text)
        want = processor.encode(text)
        assert len(ids) == 4 * len(want) and decoded == processor.decode(want)


def test_syncmers_odd(odd):
    made = {r.doc_id: r for r in anchors.edited_fingerprints(odd).collect()}
    changed = edited(ODD)
    for d, text in ODD.items():
        r = made[d]
        assert (r.n_chars, r.edited_sha256) == (len(text or ""), sha(changed[d]))
        assert r.fingerprint == syncmers(text) and r.edited_fingerprint == syncmers(changed[d])
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert made[3].near_edited == 1.0 and made[4].fingerprint == ""


def test_syncmers_query(spark, documents):
    made = {r.doc_id: r for r in QUERIES["op4_syncmers"](spark, SF).collect()}
    changed = edited(documents)
    order = sorted(documents, reverse=True)
    for d, after in zip(order, order[1:] + order[:1]):
        assert made[d].edited_sha256 == sha(changed[d]) and made[d].fingerprint == syncmers(documents[d])
        if documents[d] == documents[after]:
            assert made[d].near_next == 1.0
    # The likenesses are those of the fingerprints that are returned.
    rows = QUERIES["op4_syncmers"](spark, SF).select("doc_id", anchors.read(F.col("fingerprint")).alias("a"), anchors.read(F.col("edited_fingerprint")).alias("b"))
    again = anchors.with_overlap(rows, "a", "b", "near", "moved").collect()
    assert all((r.near, r.moved) == (made[r.doc_id].near_edited, made[r.doc_id].edited_shift) for r in again) and len(again) == len(made)
    long = [made[d].near_edited for d in documents if len(documents[d]) > 300]
    assert 0.4 < sum(long) / len(long) < 0.7


def test_syncmers_of_long_texts(df):
    import random

    draw = random.Random(3)

    def some(n):
        return [f"w{draw.randrange(10**6)}" for _ in range(n)]

    shared, tail = some(100), some(3000)
    # Two long texts with a passage in common; the same text with 40 words less at its beginning; short ones.
    texts = {9: some(4000) + shared + some(4000), 8: some(2500) + shared + some(5000), 7: some(40) + tail, 6: tail, 5: ["a", "b"], 4: []}
    texts = {d: " ".join(w) for d, w in texts.items()}
    made = {r.doc_id: r for r in anchors.edited_fingerprints(df(list(texts.items()), "doc_id long, text string")).collect()}

    def all_of(text):
        found = syncmers(text)
        return [int(found[i : i + 16], 16) for i in range(0, len(found), 16)]

    def overlap(a, b):
        a, b = {x >> 24 for x in a}, {x >> 24 for x in b}
        return len(a & b) / len(a | b) if a | b else 1.0

    order, changed = sorted(texts, reverse=True), edited(texts)
    for d, after in zip(order, order[1:] + order[:1]):
        own, new = all_of(texts[d]), all_of(changed[d])
        assert made[d].anchors == own and made[d].edited_anchors == new
        assert made[d].near_edited == overlap(own, new) and made[d].near_next == overlap(own, all_of(texts[after]))
    assert 0 < made[9].near_next < 0.02 and made[7].near_next > 0.9 and len(made[9].anchors) > 2000
    assert made[9].edited_shift == 0 and made[4].edited_shift is None and made[4].near_edited == 1.0
    given = df([(made[7].anchors, made[6].anchors), (made[9].anchors, made[8].anchors)], "a array<long>, b array<long>")
    assert [r.moved for r in anchors.with_overlap(given, "a", "b", "near", "moved").orderBy("near").collect()] == [-1500, -40]


def test_syncmers_null_and_repeated_ids(df):
    rows = [(5, "abc def"), (5, "zzz"), (None, "third text"), (9, None)]
    made = anchors.edited_fingerprints(df(rows, "doc_id long, text string")).collect()
    assert len(made) == 4 and all(r.n_chars is not None for r in made)
    one = anchors.edited_fingerprints(df([(1, "abcdef")], "doc_id long, text string")).collect()
    assert one[0].edited_sha256 == sha("abcdab")


def test_language_held_out(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    made = {r.doc_id: r for r in QUERIES["op8_language"](spark, "/root/testdata/sf0.01").collect()}
    right = total = 0
    for r in docs.select("doc_id", "lang").collect():
        out = zlib.crc32(str(r.doc_id).encode()) % 4 == 2
        assert made[r.doc_id].held_out == out and 0 <= made[r.doc_id].score <= 1
        total += out
        right += out and made[r.doc_id].lang_pred == r.lang
    assert right / total > 0.97


def test_language_odd(df, odd):
    rows = [(i, t, l) for i in range(40) for t, l in [("the house of the people", "en"), ("das haus der leute ist", "de"), ("la maison des gens", "fr")]]
    model = language.train(df(rows + [(99, None, "en"), (98, "text", None), (None, "x", "en")], "doc_id long, text string, lang string"))
    assert model.families == {"germanic": ["de", "en"], "romance": ["fr"]}
    tests = df([(1, "der leute haus"), (2, None), (3, ""), (4, "123 !!"), (5, "les gens des maison"), (6, "the people")], "doc_id long, text string")
    got = {r.row.doc_id: (r.lang_pred, r.score) for r in language.predict(tests, model).collect()}
    assert {d: v[0] for d, v in got.items()} == {1: "de", 2: "und", 3: "und", 4: "und", 5: "fr", 6: "en"}
    assert got[2][1] == 0.0
    empty = df([], "doc_id long, text string, lang string")
    assert language.predict(tests, language.train(empty)).where("lang_pred <> 'und'").count() == 0


@pytest.mark.parametrize("run", [
    lambda e: simhash.near_copies(e),
    lambda e: substrings.repeated_words(e),
    lambda e: clean.scan(e, e.selectExpr("doc_id as item_id", "text")),
    lambda e: tokens.encode(e, PIECE_MODEL),
    lambda e: anchors.edited_fingerprints(e),
])
def test_empty(df, run):
    assert run(df([], "doc_id long, text string")).collect() == []
