"""Archives, url verdicts, main texts and licence notices."""

import base64
import hashlib
import html
import io
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ridgeline.llm import licences, maintext, urls, warc
from ridgeline.llm.queries import QUERIES, table
from ridgeline.runtime import scratch_path

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def df(spark):
    return lambda rows, schema: spark.createDataFrame(rows, schema)


PAGES = [
    (1, "http://a.net/x", "<p>same</p>", "clash"),
    (2, "http://b.net/ü y\r\nz", "<p>same</p>", "clash"),
    (3, None, "<p>same</p>", "clash"),
    (4, "http://c.net", None, None),
    (5, "http://d.net", "", "clash"),
    (6, "http://e.net", "\u00e9\U0001f600 \x1f\ufffd" * 50_000, "clash"),
    (7, "http://f.net", "WARC/1.0\r\n\r\n\x1f\ufffd\x08 trap", "clash"),
    (8, "http://g.net", "once", "clash"),
    (8, "http://g.net", "once", "clash"),
    (None, "http://h.net", "no id", "clash"),
]


@pytest.fixture(scope="module")
def pages(df):
    return df(PAGES, "page_id long, url string, html string, record_type string")


def _digest(payload):
    return base64.b32encode(hashlib.sha1(payload.encode()).digest()).decode()


@pytest.mark.parametrize("file_bytes,range_bytes", [(1 << 28, 1 << 24), (1, 1 << 24), (1 << 28, 100), (1 << 28, 7)])
def test_archives_round_trip(spark, pages, file_bytes, range_bytes):
    files = warc.write_archives(warc.plan_records(pages), scratch_path(spark, "warc"), file_bytes)
    made = warc.read_archives(spark, files, range_bytes).collect()
    text = {(p, h or "") for p, _, h, _ in PAGES}
    got = sorted((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in made)
    want = []
    for p, _, h, _ in PAGES:
        last = max((q for q, _, g, _ in PAGES if (g or "") == (h or "") and q is not None), default=None)
        kind = "response" if p == last else "revisit"
        want.append((p or 0, len((h or "").encode()), _digest(h or ""), kind, last if kind == "revisit" else None))
    # Of two equal rows one is the response.
    want.remove((8, 4, _digest("once"), "response", None))
    want.append((8, 4, _digest("once"), "revisit", 8))
    assert got == sorted(want, key=lambda x: (x[0], x[1], x[2], x[3]))
    for r in made:
        if r.record_type == "response":
            assert r.digest_ok and (r.page_id, bytes(r.payload).decode()) in text
        else:
            assert r.payload is None and r.digest_ok is None


def test_archives_are_plain_gzip_members(spark, pages):
    files = warc.write_archives(warc.plan_records(pages), scratch_path(spark, "warc")).collect()
    data = b"".join(open(f.path.removeprefix("file://").removeprefix("file:"), "rb").read() for f in files)
    assert sum(f.length for f in files) == len(data) and sum(f.records for f in files) == len(PAGES)
    n = 0
    while data:
        inflate = zlib.decompressobj(31)
        record = inflate.decompress(data) + inflate.flush()
        fields, block = warc.parse_record(record)
        assert record.startswith(b"WARC/1.0\r\n") and record.endswith(b"\r\n\r\n") and len(block) == int(fields["content-length"])
        data, n = inflate.unused_data, n + 1
    assert n == len(PAGES)


def test_ranges_own_each_record_once():
    data, starts = b"\x1f\x8b\x08 no member", []
    for i in range(40):
        starts.append(len(data))
        data += warc.record_member(i, "http://x", b"\x1f\x8b\x08" * i + b"WARC/1.0", "00" * 20, 1, None, False)
    for step in (1, 13, 1000, len(data)):
        found = [at for a in range(0, len(data), step) for at, _ in warc.members(io.BytesIO(data), len(data), a, min(a + step, len(data)))]
        assert found == starts


def test_min_bytes_leaves_small_payloads_alone(pages):
    made = warc.plan_records(pages, min_bytes=5).collect()
    assert sorted(r.page_id for r in made if not r.revisit and r.length < 5) == [4, 5, 8, 8]


def test_archives_of_nothing(spark, df):
    none = df([], "page_id long, url string, html string")
    files = warc.write_archives(warc.plan_records(none), scratch_path(spark, "warc"))
    assert warc.read_archives(spark, files).collect() == []


URLS = [
    ("http://Sub.Example.NET/en/a?b#c", "sub.example.net", "/en/a", "example.net/en/", "allow"),
    ("http://example.net/EN/", "example.net", "/EN/", "net/", "block"),
    ("http://example.net", "example.net", "", None, "allow"),
    ("https://notexample.net/en/x", "notexample.net", "/en/x", "net/", "block"),
    ("http://a.org/fr/x://y.net/", "a.org", "/fr/x://y.net/", "org/fr/", "allow"),
    ("http://org?x=http://b.com/de/", "org", "", None, "allow"),
    ("http://example.com/de/#f", "example.com", "/de/", "example.com/de/", "block"),
    ("http://É.com:80/a b\nc", "É.com:80", "/a b\nc", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    ("://", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


def test_url_parts_and_rules(df):
    given = df([(i, u[0], "clash", "clash") for i, u in enumerate(URLS)], "page_id long, url string, host string, verdict string")
    made = urls.judge(given, df([], "host string, bad int"), carry=["page_id", "host"])
    got = {r.row.page_id: (r.host, r.path, r.rule, r.verdict) for r in made.collect()}
    assert got == {i: u[1:] for i, u in enumerate(URLS)}


def test_reputation_shrinks_by_host_domain_and_suffix(df):
    rows = [("bad.x.com", 1)] * 60 + [("good.x.com", 0)] * 60 + [("few.x.com", 1)] + [("fine.co.uk", 0)] * 30 + [("a.fine.co.uk", None)]
    rows += [(f"h{i}.y.com", int(i % 4 == 0)) for i in range(40) for _ in range(10)]
    made = {r.host: r for r in urls.reputations(df(rows, "host string, bad int")).collect()}
    n, bad = sum(b is not None for _, b in rows), sum(b or 0 for _, b in rows)
    counts = {}
    for h, b in rows:
        if b is not None:
            c = counts.setdefault(h, [0, 0])
            c[0], c[1] = c[0] + 1, c[1] + b
    mean = (bad + 1) / (n + 2)
    spread = sum(x * x / m for m, x in counts.values()) - 2 * mean * bad + mean * mean * n
    g = len(counts) - 1
    excess, room = spread - mean * (1 - mean) * g, mean * (1 - mean) * (n - sum(m * m for m, _ in counts.values()) / n - g)
    s = min(max(room / excess - 1, urls.MIN_STRENGTH), urls.MAX_STRENGTH)

    def rate(prior, hosts):
        return (s * prior + sum(counts[h][1] for h in hosts)) / (s + sum(counts[h][0] for h in hosts))

    com = rate(mean, [h for h in counts if h.endswith(".com")])
    x = rate(com, [h for h in counts if h.endswith("x.com")])
    for h in ("bad.x.com", "good.x.com", "few.x.com"):
        assert made[h].rate == pytest.approx(rate(x, [h]), abs=1e-6)
    assert set(made) == set(counts) and made["fine.co.uk"].n == 30
    assert made["bad.x.com"].low > urls.MAX_BAD > made["few.x.com"].low > made["good.x.com"].low >= 0


def test_hosts_without_labels_are_judged_by_their_domain(df):
    labels = df([(f"h{i}.bad.com", 1) for i in range(30) for _ in range(20)] + [(f"g{i}.org", 0) for i in range(40) for _ in range(20)], "host string, bad int")
    urls_given = ["http://new.bad.com/x", "http://new.bad.com/x", "http://new.org/", "http://deep.g1.org", "nothing", None, "http://h1.bad.com/"]
    given = df([(None if i < 2 else i, u) for i, u in enumerate(urls_given)], "page_id long, url string")
    made = urls.judge(given, labels).collect()
    assert sorted((str(r.row.page_id), r.host, r.verdict, r.n_labelled) for r in made) == sorted([
        ("None", "new.bad.com", "block", 0), ("None", "new.bad.com", "block", 0), ("2", "new.org", "allow", 0), ("3", "deep.g1.org", "allow", 0),
        ("4", "", "allow", 0), ("5", "", "allow", 0), ("6", "h1.bad.com", "block", 20),
    ])
    assert urls.judge(given.limit(0), labels).count() == 0 and urls.judge(given.limit(0), labels.limit(0)).count() == 0


def test_ranges_are_dealt_by_their_bytes(spark, df):
    """Rows of ranges are small: each range of the given bytes still has a task."""
    pages = df([(i, f"http://x/{i}", hashlib.sha256(str(i).encode()).hexdigest() * 40) for i in range(400)], "page_id long, url string, html string")
    files = warc.write_archives(warc.plan_records(pages), scratch_path(spark, "warc")).cache()
    total = files.groupBy().sum("length").first()[0]
    made = warc.read_archives(spark, files, total // 12)
    assert made.count() == 400 and made.select(F.spark_partition_id()).distinct().count() >= 8


@pytest.fixture(scope="module")
def page_model(spark):
    return maintext.train(table(spark, SF, "pages"))


def _article(page):
    """What stands in the article element of a page of the test tables."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)\b[^>]*>", inner)]
    return "\n".join(b for b in blocks if b)


def test_articles_of_the_tables(spark, page_model):
    rows = table(spark, SF, "pages").collect()
    got = page_model.extract([r.html for r in rows])
    assert sum(g == _article(r.html) for g, r in zip(got, rows)) == len(rows)


def test_other_layouts(page_model):
    page = """<HTML><body class=home><header><h1>Site</h1><a href=/>Home</a></header>
    <div class='cookie-notice'>We use cookies on this site. <button>OK</button></div>
    <div id=main><div class="post"><h2>A title &amp; more</h2><p>First   paragraph of the\n text goes on for a while, with some words.
    <p>Second paragraph, which is as long as the first one was before it, or longer.<div class="advert">Buy this thing now!</div>
    <ul><li>One item of the list in the text.<li>Another item of the list in it.</ul></div>
    <div class="sidebar widget"><h3>Popular</h3><ul><li><a href=/1>One thing</a><li><a href=/2>Other thing</a></ul></div></div>
    <section class="comments"><div class="comment"><b>Ann</b><p>I liked to read this, thanks.</p></div></section>
    <form class="newsletter"><label>Mail</label><input name=m></form><script>var a = "<p>no</p>";</script>
    <footer>&copy; 2020 Site. All rights.</footer>"""
    text = page_model.extract([page])[0]
    for part in ("A title & more", "First paragraph of the text goes on", "Second paragraph, which", "Another item"):
        assert part in text
    for part in ("cookies", "Buy this", "Popular", "Other thing", "I liked", "Mail", "All rights", "var a", "Home"):
        assert part not in text


def test_held_out_layouts(page_model):
    import random

    draw = random.Random(99)
    right = total = 0
    for _ in range(60):
        nodes = maintext.labelled(maintext.compose(draw, ["words of other pages that were not seen in training at all"]))
        kept = set(maintext.decode(nodes, page_model.trees.probability(maintext.features(nodes, page_model.odds))))
        for i, n in enumerate(nodes):
            if n.text:
                total += 1
                right += (i in kept) == (n.role == 1)
    assert right / total > 0.95


def test_decoding_never_contradicts_ancestors():
    import itertools
    import math
    import random

    draw = random.Random(5)
    nodes = maintext.parse("<div>a<p>b</p><ul><li>c<li>d</ul></div><p>e</p>")
    for _ in range(50):
        p = [draw.uniform(0.01, 0.99) for _ in nodes]

        def score(states):
            total = 0.0
            for i, (n, s) in enumerate(zip(nodes, states)):
                above = states[n.parent] if n.parent >= 0 else "t"
                if (s == "t" and (n.text or above != "t")) or (above == "d" and s != "d"):
                    return -math.inf
                total += math.log(p[i]) if s == "c" else math.log(1 - p[i]) if s == "d" else math.log(0.5)
            return total

        best = max(itertools.product("tcd", repeat=len(nodes)), key=score)
        import numpy as np

        assert maintext.decode(nodes, np.array(p)) == [i for i, n in enumerate(nodes) if n.text and best[i] == "c"]


@pytest.mark.parametrize("name", ["noscript", "svg", "object", "template", "canvas", "video", "audio", "math"])
def test_elements_that_are_never_ended_hide_nothing(name):
    def texts(page):
        return [n.text for n in maintext.parse(page) if n.text]

    assert texts(f"<p>one</p><{name} x=1><p>two</p><p>three</p>") == ["one", "two", "three"]
    assert texts(f"<p>one</p><{name} x=1><p>two</p></{name.upper()} ><p>three</p>") == ["one", "three"]
    assert texts(f"<p>one</p><{name}><{name}>gone</{name}><p>two</p>") == ["one", "two"]
    assert texts(f"<p>one</p><{name}><{name}>gone</{name}>too</{name}><p>two</p>") == ["one", "two"]
    assert texts(f"<p>one</p><{name}/><p>two</p><!-- </{name}> --><script>'</{name}>'</script><p>three</p>") == ["one", "two", "three"]


def test_capitals_are_counted_over_whole_texts():
    at = maintext.FIELDS.index("capitals")
    nodes = maintext.parse(f"<div><p>{'a' * 200}{'B' * 600}</p><p>{'c' * 200}</p></div>")
    got = {n.tag + n.text[:1]: x[at] for n, x in zip(nodes, maintext.features(nodes, {}))}
    assert got == {"html": 0.6, "div": 0.6, "p": 0.0, "#texta": 0.75, "#textc": 0.0}


def test_odd_pages(df, page_model):
    given = df([(1, None, None, "clash"), (2, "u", "", "clash"), (3, "u", "<<<>>> < a > </div></p>", "clash"), (4, "u", "<p" * 3000, "x"),
                (5, "u", "<div>" * 3000 + "deep", "x"), (6, "u", '<a title="never ended', "x")], "page_id long, url string, html string, text string")
    made = {r.row.page_id: r for r in maintext.extract(given, page_model).collect()}
    assert len(made) == 6 and made[1].text == made[2].text == "" and all(r.n_chars == len(r.text) for r in made.values())
    assert maintext.extract(given.limit(0), page_model).collect() == []


def test_parser_edges():
    def texts(page):
        return [n.text for n in maintext.parse(page) if n.text]

    assert texts("a<br>b &lt;p&gt; &#233;&nbsp;x<p>c<b>d</b>e<td>f") == ["a b <p> é x", "cde", "f"]
    assert texts("<style>p{}</style>x<script>if (a<b) '</p>'</script>y<!-- <p>no -->z") == ["x yz"] or texts("x<!-- <p>no -->z") == ["xz"]
    assert texts("<head><title>t</title></head><body>b</body>") == ["b"]
    assert texts("<noscript><p>n</p></noscript>m") == ["m"]


NOTICES = {
    1: "Some prose.\nLicensed under the Apache License, Version 2.0.\nMore prose of it.",
    2: "Released under the MIT License.",
    3: "This work is licensed under the GNU General Public License, version 3.",
    4: "x\n\nLicensed under CC BY-NC 4.0.\n" + "words and words " * 3000,
    5: "The licence of the driver was under the seat, and the work went on under the version of the public house.",
    6: None,
    7: "",
    8: "word " * 40 + "this program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License " + "word " * 40,
}


@pytest.fixture(scope="module")
def licence_model(spark):
    return licences.train(table(spark, SF, "documents"))


def test_notices(df, licence_model):
    given = df([(k, v, "clash") for k, v in NOTICES.items()], "doc_id long, text string, notices string")
    made = {r.row.doc_id: r for r in licences.scan(given, licence_model).collect()}
    want = {1: ["apache-2.0"], 2: ["mit"], 3: ["gpl"], 4: ["cc-by-nc"], 5: [], 6: [], 7: [], 8: ["gpl"]}
    assert {k: list(r.families) for k, r in made.items()} == want
    first = made[1].notices[0]
    assert NOTICES[1].encode()[first.start : first.end] == b"Licensed under the Apache License, Version 2.0"
    assert licences.scan(given.limit(0), licence_model).collect() == []
    assert licences.train(given.limit(0)).names[-1] == licences.UNKNOWN


def test_notices_of_the_tables(spark):
    known = {
        "Licensed under the Apache License, Version 2.0.": "apache-2.0", "Released under the MIT License.": "mit",
        "This work is licensed under the GNU General Public License, version 3.": "gpl", "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "All rights reserved.": "proprietary",
    }
    want = {
        r.doc_id: ",".join(sorted({f for line, f in known.items() if line in r.text.split("\n")}))
        for r in table(spark, SF, "documents").collect()
    }
    got = {r.doc_id: r.families for r in QUERIES["op5_licences"](spark, SF).collect()}
    assert got == want


def test_window_scores_match_vectors(licence_model):
    import numpy as np
    from ridgeline.llm.texts import Texts

    text = " ".join(f"w{i % 7}" for i in range(75)) + "\nLicensed under CC BY 4.0."
    one = licences.Paragraphs(Texts(pa.array([text])))
    scores = one.scores(licence_model.weights, licence_model.bias)
    for i in range(len(one.begin)):
        v = one.vectors(i)
        want = sum(licence_model.weights[c].astype(float) * x for c, x in v.items()) + licence_model.bias
        assert np.allclose(scores[i], want, atol=1e-3)


def test_every_notice_of_a_line(df, licence_model):
    filler = "plain words of an ordinary sentence about the river and the town " * 30
    texts = {
        1: filler + "Released under the MIT License. " + filler + "Licensed under CC BY 4.0. " + filler,
        2: "Released under the MIT License. Licensed under CC BY 4.0.",
        3: filler + "Licensed under CC BY 4.0. " + filler + "Licensed under CC BY 4.0. " + filler,
        4: "Licensed under CC BY-NC 4.0. " + "Released under the MIT License. " * 500,
    }
    want = {1: ["mit", "cc-by"], 2: ["mit", "cc-by"], 3: ["cc-by", "cc-by"], 4: ["cc-by-nc"] + ["mit"] * 500}
    held = {"mit": "Released under the MIT License", "cc-by": "Licensed under CC BY 4.0", "cc-by-nc": "Licensed under CC BY-NC 4.0"}
    for r in licences.scan(df(list(texts.items()), "doc_id long, text string"), licence_model).collect():
        sure = [n for n in r.notices if n.confirmed]
        assert [n.family for n in sure] == want[r.row.doc_id] and list(r.families) == sorted(set(want[r.row.doc_id]))
        assert all(texts[r.row.doc_id].encode()[n.start : n.end].decode() == held[n.family] and n.template == 1 for n in sure)


def test_wrapped_notices(df, licence_model):
    texts = {
        "bsd": "/*\n * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions\n * are met:\n */",
        "gpl": "prose before it\nThis program is free software: you can redistribute it and/or modify\r\nit under the terms of the GNU General Public License as published by\r\n",
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a\ncopy of this software and associated\ndocumentation files (the \"Software\"), to deal",
        "": "All rights\n\nreserved.",
    }
    made = licences.scan(df([(i, t) for i, t in enumerate(texts.values())], "doc_id long, text string"), licence_model)
    assert {r.row.doc_id: ",".join(r.families) for r in made.collect()} == dict(enumerate(texts))
    assert all(sum(n.confirmed for n in r.notices) == (r.families != []) for r in made.collect())
