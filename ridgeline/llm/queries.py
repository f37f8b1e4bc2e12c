"""The operators over the given tables, with their SQL where SQL can tell the result."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import PATTERN
from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.llm import (
    bytepairs, decontaminate, language, licences, maintext, phrases, pieces, prefixes, simhash, substrings, syncmers, urls,
    warc,
)
from ridgeline.runtime import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

PIECE_MODEL = tokenizer_path("piece_bpe_32k.model")
BYTE_RANKS = tokenizer_path("byte_bpe_multi_50k.tiktoken")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents"))


# Five hex digits of a digest are four base32 digits.
_BASE32 = "array_to_string(list_transform(range(0, 8), lambda g: " + " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(sha, CAST(5 * g + 1 AS BIGINT), 5) AS BIGINT) >> {s}) & 31) + 1, 1)"
    for s in (15, 10, 5, 0)
) + "), '')"


@query(f"""
WITH given AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS sha FROM pages
), known AS (
  SELECT page_id, strlen(payload) AS payload_bytes, sha, max(page_id) OVER (PARTITION BY payload) AS last_id FROM given
)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = last_id THEN NULL ELSE last_id END AS refers_to
FROM known
""")
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.plan_records(table(spark, sf_dir, "pages"))
    files = warc.write_archives(records, scratch_path(spark, "warc"))
    made = warc.read_archives(spark, files, payloads=False)
    return made.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = pieces.encode(table(spark, sf_dir, "documents"), PIECE_MODEL, keep=False)
    return made.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query()
def op4_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edited_fingerprints(table(spark, sf_dir, "documents"))


@query()
def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    made = licences.scan(docs, licences.train(docs))
    return made.select(
        "row.doc_id", F.size("notices").cast("long").alias("n_notices"),
        F.size(F.filter("notices", lambda n: n["confirmed"])).cast("long").alias("n_confirmed"),
        F.array_join("families", ",").alias("families"),
    )


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(f"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format('text')} AS w FROM benchmark
), patterns AS (
  SELECT item, unnest(range(1, greatest(2, len(w) - 11))) AS pos, w FROM items WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item, array_to_string(w[pos:pos + 12], ' ') AS pattern, least(len(w), 13) AS n FROM patterns
), docs AS (
  SELECT doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents
), sizes AS (SELECT DISTINCT n FROM windows
), places AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS pos, w FROM docs, sizes WHERE len(w) >= n
), found AS (
  SELECT p.doc_id, p.pos, p.n, t.item
  FROM (SELECT doc_id, n, pos, array_to_string(w[pos:pos + n - 1], ' ') AS pattern FROM places) p
  JOIN windows t ON t.pattern = p.pattern AND t.n = p.n
), hit AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS word FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
""")
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), unnamed=True)
    return made.select(
        "row.doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


@query(r"""
WITH docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), windows AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY seq ORDER BY doc_id, pos) > 1 AS again
  FROM (SELECT doc_id, pos, array_to_string(w[pos:pos + 19], ' ') AS seq
        FROM (SELECT doc_id, unnest(range(1, len(w) - 18)) AS pos, w FROM docs WHERE len(w) >= 20))
), gone AS (
  SELECT DISTINCT doc_id, word FROM (SELECT doc_id, unnest(range(pos, pos + 20)) AS word FROM windows WHERE again)
), lost AS (
  SELECT doc_id, list(word) AS places FROM gone GROUP BY doc_id
), kept AS (
  SELECT doc_id, len(w) AS n, coalesce(len(places), 0) AS n_removed,
    array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(places, []), i)), ' ') AS left_words
  FROM docs LEFT JOIN lost USING (doc_id)
)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed, sha256(left_words) AS kept_sha256 FROM kept
""")
def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = substrings.repeated_words(table(spark, sf_dir, "documents"))
    return made.select("row.doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query()
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    made = language.predict(docs, language.train(docs))
    named = made.select("row.doc_id", "lang_pred", "score")
    return named.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(host, bad)`` for pages whose url names a labelled document: bad if of low quality or toxic."""
    url = F.col("url")
    named = table(spark, sf_dir, "pages").select(
        urls.host_of(url).alias("host"), F.regexp_extract(urls.path_of(url), r"^/[^/]*/(\d{1,18})", 1).alias("number")
    ).where("number <> ''").select("host", F.col("number").cast("long").alias("doc_id"))
    marks = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad"))
    return named.join(marks, "doc_id").select("host", "bad")


_HOST = _LOWER.format("regexp_extract(coalesce({url}, ''), '(?s)^.*?://([^/?#]*)', 1)")
_PATH = "regexp_extract(coalesce({url}, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
_TWO = ", ".join(f"'{s}'" for s in urls.TWO_PART_SUFFIXES)
_BARE = r"regexp_replace(host, ':\d*$', '')"
_NAMES = f"string_split({_BARE}, '.')"


def _rule_cases(pick: int) -> str:
    rules = sorted(urls.RULES, key=lambda r: -len(r[0]))
    cases = []
    for rule in rules:
        name, slash, rest = rule[0].partition("/")
        cases.append(f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash}{rest}') THEN '{rule[pick]}'")
    return f"CASE {' '.join(cases)} END"


@query(rf"""
WITH given AS (
  SELECT page_id, {_HOST.format(url='url')} AS host, {_PATH.format(url='url')} AS path FROM pages
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id
), outcomes AS (
  SELECT host, bad FROM given JOIN marks ON marks.doc_id = TRY_CAST(nullif(regexp_extract(path, '^/[^/]*/(\d{{1,18}})', 1), '') AS BIGINT)
  WHERE host <> ''
), counts AS (
  SELECT host, {_NAMES} AS names, CAST(count(bad) AS BIGINT) AS n, coalesce(sum(bad), 0) AS bad
  FROM (SELECT host, bad FROM outcomes UNION ALL SELECT DISTINCT host, CAST(NULL AS INTEGER) FROM given WHERE host <> '') GROUP BY host
), two AS (
  SELECT *, array_to_string(names[-2:], '.') AS last_two FROM counts
), every AS (
  SELECT host, CAST(n AS DOUBLE) AS n, CAST(bad AS DOUBLE) AS bad,
    CASE WHEN last_two IN ({_TWO}) THEN array_to_string(names[-3:], '.') ELSE last_two END AS domain,
    CASE WHEN last_two IN ({_TWO}) THEN last_two ELSE names[-1] END AS suffix
  FROM two
), hosts AS (SELECT * FROM every WHERE n > 0
), whole AS (
  SELECT coalesce(sum(n), 0) AS n, coalesce(sum(bad), 0) AS bad, coalesce(sum(n * n), 0) AS squares, CAST(count(*) AS DOUBLE) AS hosts,
    CAST(coalesce(sum(CAST(round(bad * bad / n, 9) AS DECIMAL(28, 9))), 0) AS DOUBLE) AS spread
  FROM hosts
), moments AS (
  SELECT *, (bad + 1) / (n + 2) AS mean FROM whole
), excess AS (
  SELECT n, mean, spread - 2 * mean * bad + mean * mean * n - mean * (1 - mean) * (hosts - 1) AS excess,
    mean * (1 - mean) * (n - squares / greatest(n, 1.0) - (hosts - 1)) AS room
  FROM moments
), prior AS (
  SELECT mean, least(greatest(CASE WHEN excess > 0 AND room > 0 THEN room / excess - 1 ELSE {urls.MAX_STRENGTH} END, {urls.MIN_STRENGTH}), {urls.MAX_STRENGTH}, n + 2) AS s
  FROM excess
), suffixes AS (
  SELECT suffix, (s * mean + sum(bad)) / (s + sum(n)) AS rate FROM hosts, prior GROUP BY suffix, s, mean
), domains AS (
  SELECT h.domain, h.suffix, (s * x.rate + sum(h.bad)) / (s + sum(h.n)) AS rate
  FROM hosts h JOIN suffixes x ON x.suffix = h.suffix, prior GROUP BY h.domain, h.suffix, s, x.rate
), rates AS (
  SELECT h.host, h.n, h.bad, s, (s * coalesce(d.rate, x.rate, mean) + h.bad) / (s + h.n) AS rate
  FROM prior, every h LEFT JOIN domains d ON d.domain = h.domain AND d.suffix = h.suffix LEFT JOIN suffixes x ON x.suffix = h.suffix
), known AS (
  SELECT host, n, bad, rate - {urls.BOUND_Z} * sqrt(rate * (1 - rate) / (s + n + 1)) AS low FROM rates
)
SELECT page_id, g.host, path, {_rule_cases(0).replace('host', 'g.host')} AS rule,
  coalesce({_rule_cases(1).replace('host', 'g.host')}, CASE WHEN low > {urls.MAX_BAD} THEN 'block' ELSE 'allow' END) AS verdict,
  CAST(coalesce(n, 0) AS BIGINT) AS n_labelled, CAST(coalesce(bad, 0) AS BIGINT) AS n_bad
FROM given g LEFT JOIN known k ON k.host = g.host
""")
def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = urls.judge(table(spark, sf_dir, "pages"), page_outcomes(spark, sf_dir))
    return made.select("row.page_id", "host", "path", "rule", "verdict", "n_labelled", "n_bad")


@query()
def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    made = maintext.extract(pages, maintext.train(pages))
    return made.select("row.page_id", "row.url", "text", "n_chars")


# CRC-32 of a decimal number, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST({} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda v, i: xor(v >> 1, (v & 1) * 3988292384))))"""


@query(f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), turns AS (
  SELECT conv_id, id, size, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, id) - 1 AS pos
  FROM (SELECT *, md5(strlen(role) || ':' || role || text) AS id, strlen(text) AS size FROM given)
), convs AS (
  SELECT conv_id, conv_id - conv_id % {prefixes.GROUP} AS first, {_CRC32.format('conv_id')} % {prefixes.HEADS} AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
), made AS (
  SELECT c.conv_id, 0 AS part, pos, id, size FROM convs c JOIN turns t ON t.conv_id = c.first AND pos < h
  UNION ALL SELECT c.conv_id, 1, pos, id, size FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND pos >= h
), paths AS (
  SELECT conv_id, coalesce(ids, []) AS ids, sizes
  FROM convs LEFT JOIN (
    SELECT conv_id, list(id ORDER BY part, pos) AS ids, list(size ORDER BY part, pos) AS sizes FROM made GROUP BY conv_id
  ) USING (conv_id)
), prefixes AS (
  SELECT conv_id, d, ids[1:d] AS path, coalesce(sizes[d], 0) AS size, len(ids) = d AS ends FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM paths)
), nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
    string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends) AS ends, bool_and(ends) AS leaf
  FROM prefixes GROUP BY path, d
), subtrees AS (
  SELECT path[1:a] AS path, sum(CASE WHEN leaf THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM nodes) GROUP BY path[1:a]
), children AS (
  SELECT path[1:d - 1] AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY path[1:d - 1]
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
  CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN subtrees s ON s.path = n.path LEFT JOIN children c ON c.path = n.path
LEFT JOIN nodes p ON n.d > 0 AND p.path = n.path[1:n.d - 1]
""")
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.conversation_trie(table(spark, sf_dir, "conversations"))


@query()
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = bytepairs.encode(table(spark, sf_dir, "documents"), BYTE_RANKS, PATTERN, keep=False)
    return made.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query(rf"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, {_LOWER.format("coalesce(text, '')")} AS text FROM documents
), pieces AS (
  SELECT lang, regexp_extract_all(unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM docs
), words AS (
  SELECT lang, unnest(list_zip(w, w[2:], w[3:])) AS z FROM pieces
), three AS (
  SELECT lang, z[1] AS x, z[2] AS y, z[3] AS z FROM words
), grams AS (
  SELECT lang, 1 AS k, x AS phrase FROM three WHERE x IS NOT NULL
  UNION ALL SELECT lang, 2, x || ' ' || y FROM three WHERE y IS NOT NULL
  UNION ALL SELECT lang, 3, x || ' ' || y || ' ' || z FROM three WHERE z IS NOT NULL
), counts AS (
  SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang
), long AS (
  SELECT lang, k, phrase, f, i, array_to_string(w[1:i], ' ') AS head, array_to_string(w[i + 1:k], ' ') AS tail
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS i FROM counts WHERE k > 1 AND f >= {phrases.MIN_COUNT})
), cuts AS (
  SELECT c.lang, c.k, c.phrase, c.f AS a, l.f AS l, r.f AS r, i, {phrases.SCALE} * c.f * c.f // (l.f * r.f) AS score
  FROM long c JOIN counts l ON l.lang = c.lang AND l.phrase = c.head JOIN counts r ON r.lang = c.lang AND r.phrase = c.tail
), candidates AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1
), longer AS (
  SELECT lang, array_to_string(string_split(phrase, ' ')[s:s + 1], ' ') AS phrase, max(a) AS beyond
  FROM candidates, (VALUES (1), (2)) AS sides(s) WHERE k = 3 GROUP BY ALL
), kept AS (
  SELECT c.* FROM candidates c LEFT JOIN longer b ON c.k = 2 AND b.lang = c.lang AND b.phrase = c.phrase
  WHERE beyond IS NULL OR 100 * beyond < {phrases.COVER_PERCENT} * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= {phrases.TOP}
""")
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))
