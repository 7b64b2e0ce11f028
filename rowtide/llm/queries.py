"""Registered queries of the training-data operators, with their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, collocations, decontam, html_extract, jaccard_join, lang_id, line_dedup, packing, repetition, suffix_dedup, toxicity, url_filter, whitening
from .common import table

QUERIES = {}
SQL = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f
    return add


def _sql_terms(terms: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{t}'" for t in terms) + "]"


def _sql_found(terms: tuple[str, ...]) -> str:
    return f"[t FOR t IN {_sql_terms(tuple(sorted(terms)))} IF regexp_matches(u, '(^|[^a-z0-9])' || t || '($|[^a-z0-9])')]"


@query("op1_url_filter", f"""
WITH p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
         translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u
  FROM pages),
r(h, q, v) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in url_filter.RULES)}),
m AS (
  SELECT p.*,
         (SELECT arg_max(h || q || ' ' || v, length(h || q)) FROM r
          WHERE (p.host = h OR ends_with(p.host, '.' || h)) AND starts_with(p.path, q)) AS fit,
         {_sql_found(url_filter.STRICT)} AS s, {_sql_found(url_filter.SOFT)} AS f
  FROM p)
SELECT page_id, host, path, split_part(fit, ' ', 1) AS rule,
       CASE WHEN fit IS NOT NULL THEN split_part(fit, ' ', 2)
            WHEN len(s) > 0 OR len(f) >= 2 THEN 'block' ELSE 'allow' END AS verdict,
       CAST(len(s) AS BIGINT) AS n_strict, CAST(len(f) AS BIGINT) AS n_soft,
       coalesce(array_to_string(s, ' '), '') AS strict_terms, coalesce(array_to_string(f, ' '), '') AS soft_terms
FROM m
""")
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


@query("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                       public_tokenizers.PATTERN)


# repeats of at least 5 words cover just what repeated 5-word windows cover; a repeat is
# longer than 100 words if a 101-word window occurs twice
QUALITY_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (
  SELECT r, line, count(*) AS c FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL),
dup AS (SELECT r, sum(c - 1) AS n FROM l GROUP BY r),
u AS (SELECT r, unnest(w) AS x, unnest(range(len(w))) AS i FROM d),
s AS (
  SELECT r, i, x || ' ' || lead(x, 1) OVER v || ' ' || lead(x, 2) OVER v || ' ' || lead(x, 3) OVER v || ' ' || lead(x, 4) OVER v AS five
  FROM u WINDOW v AS (PARTITION BY r ORDER BY i)),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, five) AS c FROM s WHERE five IS NOT NULL),
p AS (SELECT DISTINCT r, unnest([i, i + 1, i + 2, i + 3, i + 4]) AS i FROM g WHERE c > 1),
cov AS (SELECT r, count(*) AS n, sum(length(x)) AS chars FROM p JOIN u USING (r, i) GROUP BY r),
h AS (
  SELECT DISTINCT r FROM (
    SELECT r, string_agg(x, ' ') OVER v AS t, count(*) OVER v AS n FROM u WHERE r IN (SELECT r FROM cov WHERE n > 101)
    WINDOW v AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 100 FOLLOWING))
  WHERE n = 101 GROUP BY r, t HAVING count(*) > 1),
o AS (
  SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(cov.chars, 0) AS BIGINT) AS covered_chars, h.r IS NOT NULL AS long_repeat
  FROM d LEFT JOIN dup USING (r) LEFT JOIN cov USING (r) LEFT JOIN h USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_chars,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR covered_chars > 0.25 * word_chars OR long_repeat) AS kept
FROM o
"""


@query("op8_quality_rules", QUALITY_SQL)
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.quality(table(spark, sf_dir, "documents")).drop("longest_repeat")


@query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lang_id.predict(docs, lang_id.train(docs))


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query("op4_html_extraction")
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


# pairs one edit apart share their first or second half; the edit itself is sought place by place
LINE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, string_split(text, chr(10)) AS l FROM documents),
x AS (SELECT r, doc_id, unnest(range(len(l))) AS no, unnest(l) AS raw FROM d),
y AS (SELECT *, trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line FROM x),
f AS (SELECT line, min({'d': doc_id, 'n': no}) AS pos FROM y WHERE line <> '' GROUP BY line),
u AS (SELECT line, pos, length(line) AS n FROM f WHERE length(line) >= 20),
k AS (SELECT *, unnest([n, n - 1]) AS base FROM u),
h AS (SELECT *, 'a' || left(line, base // 2) AS half FROM k UNION ALL SELECT *, 'b' || right(line, base - base // 2) FROM k),
p AS (
  SELECT DISTINCT a.line AS a, b.line AS b FROM h a JOIN h b USING (base, half)
  WHERE b.pos < a.pos AND (a.n = base OR b.n = base)),
e AS (
  SELECT DISTINCT a FROM p WHERE len([i FOR i IN range(greatest(length(a), length(b)))
    IF left(a, i) = left(b, i) AND (substr(a, i + 2) = substr(b, i + 2) OR substr(a, i + 2) = substr(b, i + 1)
                                     OR substr(a, i + 1) = substr(b, i + 2))]) > 0),
z AS (
  SELECT y.r, y.no, y.raw, y.line <> '' AS is_line,
         y.line = '' OR (f.pos = {'d': y.doc_id, 'n': y.no} AND e.a IS NULL) AS stays
  FROM y LEFT JOIN f USING (line) LEFT JOIN e ON e.a = y.line),
g AS (
  SELECT r, string_agg(raw, chr(10) ORDER BY no) FILTER (stays) AS t, count(*) FILTER (is_line) AS n,
         count(*) FILTER (is_line AND NOT stays) AS gone FROM z GROUP BY r)
SELECT doc_id, CASE WHEN text IS NOT NULL THEN sha256(coalesce(g.t, '')) END AS text_sha256,
       coalesce(g.n, 0) AS n_lines, coalesce(g.gone, 0) AS n_removed
FROM d LEFT JOIN g USING (r)
"""


@query("op2_line_dedup", LINE_SQL)
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.sha2("text", 256).alias("text_sha256"), "n_lines", "n_removed")


def _sql_template(text: str) -> str:
    """The template words of a text expression."""
    def quoted(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    t = f"coalesce({text}, '')"
    for pattern, to, times in ((decontam.NAMED, rf"\1{decontam.NAME}", 2), (decontam.NUMBERED, rf"\1{decontam.NUMBER}\2", 2),
                               (None, None, 1), (decontam.MEASURED, rf"{decontam.NUMBER}\1{decontam.UNIT}\2", 1),
                               (decontam.EDGES, r"\1\2", 2)):
        for _ in range(times):
            t = f"regexp_replace({t}, {quoted(pattern)}, {quoted(to)}, 'g')" if pattern else f"lower({t})"
    return f"[w FOR w IN string_split_regex({t}, '[{decontam.WHITE}]+') IF w <> '']"


def _sql_raw(text: str) -> str:
    edge = decontam.EDGE
    return (rf"[regexp_replace(regexp_replace(lower(w), '^{edge}+', ''), '(?:[''’]s)?{edge}*$', '') FOR w IN "
            rf"string_split_regex({text}, '[{decontam.WHITE}]+') IF regexp_matches(w, '[\p{{L}}\p{{N}}%<>]')]")


def _sql_plain(text: str) -> str:
    """The words of a text in lower case without what surrounds them."""
    edge = decontam.EDGE
    return (rf"[CASE WHEN regexp_matches(w, '[\p{{L}}\p{{N}}%<>]') THEN regexp_replace(regexp_replace(w, '^{edge}+', ''), '(?:[''’]s)?{edge}*$', '') ELSE w END "
            rf"FOR w IN string_split_regex(lower(coalesce({text}, '')), '[{decontam.WHITE}]+') IF w <> '']")


LEAK_SQL = rf"""
WITH b AS (SELECT item_id, w, v, least(len(w), 8) AS size FROM (
       SELECT item_id, {_sql_template("text")} AS w, {_sql_raw("text")} AS v FROM benchmark) WHERE len(w) >= 5),
d AS (SELECT doc_id, {_sql_template("text")} AS w, {_sql_raw("text")} AS v FROM documents),
bw AS (
  SELECT item_id, size, i AS at0, array_to_string(w[i + 1:i + size], ' ') AS x
  FROM (SELECT *, unnest(range(len(w) - size + 1)) AS i FROM b)
  WHERE 2 * len([s FOR s IN w[i + 1:i + size] IF s IN ('<number>', '<unit>', '<name>')]) <= size),
n AS (SELECT item_id, count(*) AS n FROM bw GROUP BY item_id),
dx AS (SELECT doc_id, i, unnest(w) AS x, unnest(range(len(w))) AS p FROM (SELECT *, 0 AS i FROM d)),
dw AS (
  SELECT doc_id, p AS at1, size, x FROM (
    {" UNION ALL ".join(
        f"SELECT doc_id, p, {k} AS size, x || {' || '.join(f'''' ' || lead(x, {j}) OVER (PARTITION BY doc_id ORDER BY p)''' for j in range(1, k))} AS x FROM dx"
        for k in range(5, 9))}) WHERE x IS NOT NULL),
hit AS (SELECT DISTINCT doc_id, item_id, bw.size, at0, at1 - at0 AS diagonal FROM dw JOIN bw USING (size, x)),
slot AS (
  SELECT DISTINCT doc_id, item_id, diagonal, q, b.v[q + 1] AS theirs, d.v[q + diagonal + 1] AS ours
  FROM (SELECT *, unnest(range(at0, at0 + size)) AS q FROM hit) JOIN b USING (item_id) JOIN d USING (doc_id)
  WHERE b.w[q + 1] IN ('<number>', '<unit>', '<name>')),
pairs AS (SELECT doc_id, item_id, diagonal, theirs, ours, (theirs IS NOT DISTINCT FROM ours)::INT AS same, count(*) AS c FROM slot GROUP BY ALL),
ranked AS (SELECT *, rank() OVER (PARTITION BY doc_id, item_id, diagonal, theirs ORDER BY same DESC, c DESC) AS r FROM pairs),
-- an item's value that meets several: the same one stays, else the most frequent, none of equally frequent ones
torn AS (SELECT * FROM (SELECT *, count(*) FILTER (r = 1) OVER (PARTITION BY doc_id, item_id, diagonal, theirs) AS winners FROM ranked) WHERE r > 1 OR winners > 1),
bad AS (SELECT DISTINCT s.doc_id, s.item_id, s.diagonal, s.q FROM slot s JOIN torn t ON s.doc_id = t.doc_id AND s.item_id = t.item_id AND s.diagonal = t.diagonal
        AND s.theirs IS NOT DISTINCT FROM t.theirs AND s.ours IS NOT DISTINCT FROM t.ours),
good AS (SELECT * FROM hit WHERE NOT EXISTS (SELECT 1 FROM bad WHERE bad.doc_id = hit.doc_id AND bad.item_id = hit.item_id AND bad.diagonal = hit.diagonal
         AND q >= at0 AND q < at0 + size)),
steps AS (SELECT *, CASE WHEN at0 - lag(at0) OVER l <= size THEN 0 ELSE 1 END AS new FROM good WINDOW l AS (PARTITION BY doc_id, item_id, diagonal ORDER BY at0)),
runs AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY at0) AS k FROM steps),
run AS (SELECT doc_id, item_id, max(w) AS run FROM (SELECT doc_id, item_id, max(at0) + max(size) - min(at0) AS w FROM runs GROUP BY doc_id, item_id, diagonal, k) GROUP BY ALL),
windows AS (
  SELECT doc_id, item_id, n_matched, n_matched / n.n AS share
  FROM (SELECT doc_id, item_id, count(DISTINCT at0) AS n_matched FROM good GROUP BY ALL) JOIN n USING (item_id) JOIN run USING (doc_id, item_id)
  WHERE n_matched >= 0.6 * n.n OR run >= 13),
-- items without countable windows, word by word
bare AS (SELECT item_id, {_sql_plain("text")} AS p FROM benchmark WHERE item_id NOT IN (SELECT item_id FROM n)),
held AS (SELECT doc_id, item_id, len(p) - least(len(p), 8) + 1 AS n_matched, 1.0 AS share FROM bare
         JOIN (SELECT doc_id, {_sql_plain("text")} AS dp FROM documents) ON len(p) > 0 AND contains(' ' || array_to_string(dp, ' ') || ' ', ' ' || array_to_string(p, ' ') || ' '))
SELECT doc_id, item_id, max(n_matched) AS n_matched, max(share) AS share FROM (SELECT * FROM windows UNION ALL SELECT * FROM held) GROUP BY ALL
"""


@query("op7_benchmark_decontamination", LEAK_SQL)
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), min_run=13, meet=True)


@query("op10_suffix_dedup")
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.dedup(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_ngram_jaccard_join")
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(table(spark, sf_dir, "documents"))


@query("op11_packing")
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return pieces.select("doc_id", "start", F.col("length").cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", F.col("offset").cast("long").alias("offset"))


@query("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def _sql_sum(k: int) -> str:
    """Phrases of ``k`` words with their count, from the words ``w`` of pieces."""
    rest = "".join(f" || ' ' || lead(w, {j}) OVER v" for j in range(1, k))
    return (f"SELECT lang, {k} AS k, phrase, count(*)::HUGEINT AS f FROM (SELECT lang, w{rest} AS phrase FROM w "
            "WINDOW v AS (PARTITION BY piece ORDER BY pos)) WHERE phrase IS NOT NULL GROUP BY ALL")


PHRASE_SQL = rf"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
p AS (SELECT row_number() OVER () AS piece, lang, t FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS t FROM d)),
x AS (SELECT piece, lang, regexp_extract_all(t, '[^\x20\x09]+') AS ws FROM p),
w AS (SELECT piece, lang, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM x),
n AS (SELECT lang, count(*)::HUGEINT AS n FROM w GROUP BY lang),
f AS ({" UNION ALL ".join(_sql_sum(k) for k in (1, 2, 3))}),
g AS (SELECT *, string_split(phrase, ' ') AS s FROM f WHERE k > 1 AND f >= 10),
c AS (SELECT *, unnest(range(1, k)) AS cut FROM g),
s AS (
  SELECT c.lang, c.k, c.phrase, c.f AS a, l.f AS l, r.f AS r, cut, 1000000::HUGEINT * c.f * c.f // (l.f * r.f) AS score
  FROM c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.s[:cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.s[cut + 1:], ' ')),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (
  SELECT lang, phrase, max(f) AS most FROM (
    SELECT lang, f, unnest([array_to_string(s[:2], ' '), array_to_string(s[2:], ' ')]) AS phrase FROM g WHERE k = 3) GROUP BY ALL),
o AS (
  SELECT m.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM m LEFT JOIN i USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * a)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM o JOIN n USING (lang) WHERE rank <= 2000
"""


@query("op13_phrase_collocations", PHRASE_SQL)
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))
