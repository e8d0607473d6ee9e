"""The operators with production parameters on the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabstand.llm import contents, counts, credentials, divergence, hnsw, lines, mixing, neardup, packing, passages, periods, rules, suffixes
from cabstand.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the bytes that 100-byte strings from further up repeat."""
    left = suffixes.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut into pieces and packed into sequences of 1024 tokens."""
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), *byte_bpe()))


def op3_near_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that shares a passage of 50 words or more with another one, the passages and their class."""
    return passages.near_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every drawn copy of a document, sources weighed by the square root of their size, in the order of the shuffle."""
    docs = table(spark, sf_dir, "documents")
    return mixing.mixed_copies(docs).select("doc_id", "source", F.col("copy").cast("long").alias("copy"), "shuffle_key")


OP4_SQL = """
WITH RECURSIVE sizes AS (
  SELECT source, CAST(sum(coalesce(length(text), 0)) AS BIGINT) AS size FROM documents GROUP BY source
),
totals AS (SELECT CAST(sum(size) AS DOUBLE) AS a, sum(sqrt(CAST(size AS DOUBLE))) FILTER (size > 0) AS w FROM sizes),
rates AS (
  SELECT source, CASE WHEN size = 0 THEN 1.0::DOUBLE ELSE sqrt(CAST(size AS DOUBLE)) / w * a / size END AS rate
  FROM sizes, totals
),
cdf AS (
  SELECT source, rate, 0 AS k, -rate AS lg, exp(-rate) AS below FROM rates
  UNION ALL
  SELECT source, rate, k + 1, lg + ln(rate / (k + 1)), below + exp(lg + ln(rate / (k + 1))) FROM cdf
  WHERE k < ceil(rate + 12 * sqrt(rate) + 30)
),
drawn AS (
  SELECT row_number() OVER () AS r, doc_id, source,
    CAST('0x' || substr(md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
  FROM documents
),
counts AS (
  SELECT r, doc_id, d.source, count(*) FILTER (below <= u) AS n
  FROM drawn d JOIN cdf c ON d.source IS NOT DISTINCT FROM c.source GROUP BY r, doc_id, d.source
),
copies AS (SELECT doc_id, source, unnest(range(1, n + 1)) AS copy FROM counts)
SELECT doc_id, source, CAST(copy AS BIGINT) AS copy,
  CAST('0x' || substr(md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || copy), 1, 13) AS BIGINT) AS shuffle_key
FROM copies
"""


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals of every text and the verdict on it after lines that its source repeats are set aside."""
    judged = rules.verdicts(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "signals.*", F.col("shared_words").alias("n_shared_words"), "kept")


OP5_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t, text FROM documents),
w AS (SELECT r, doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
grams AS (
  SELECT r, i, md5(w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) > 2)
),
again AS (SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
repeats AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM again) GROUP BY r),
raw AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
),
even AS (
  SELECT r, source, md5(t) AS k,
    unnest(string_split(regexp_replace(regexp_replace(lower(t), '[\x20\x09\x0B-\x0D]+', ' ', 'g'), '[0-9]+', '0', 'g'), chr(10))) AS line
  FROM d
),
lines AS (SELECT r, source, k, trim(line, ' ') AS line FROM even WHERE trim(line, ' ') <> ''),
texts AS (SELECT source, count(DISTINCT md5(text)) AS n FROM d WHERE text IS NOT NULL GROUP BY source),
above AS (
  SELECT l.source, l.line FROM (SELECT source, line, count(DISTINCT k) AS n FROM lines GROUP BY source, line) l
  JOIN texts t ON l.source IS NOT DISTINCT FROM t.source
  WHERE l.n >= 20 AND l.n >= t.n * CAST(0.01 AS DOUBLE)
),
shared AS (
  SELECT l.r, sum(len(string_split(l.line, ' '))) AS n FROM lines l
  JOIN above a ON l.source IS NOT DISTINCT FROM a.source AND l.line = a.line GROUP BY l.r
),
base AS (
  SELECT w.r, doc_id, len(w.w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(dup.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words, coalesce(shared.n, 0) AS n_shared_words
  FROM w LEFT JOIN dup USING (r) LEFT JOIN repeats USING (r) LEFT JOIN shared USING (r)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, CAST(n_shared_words AS BIGINT) AS n_shared_words,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_shared_words <= n_words * CAST(0.5 AS DOUBLE) AS kept
FROM base
"""


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the patterns' spans in every document, a digest of them, and all spans with the inferred formats."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = credentials.scanned(docs, credentials.infer_formats(docs))
    base = F.filter("found", lambda s: s["kind"] != "inferred")
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    return found.select(
        "doc_id",
        *[count(kind) for kind in credentials.KINDS[:3]],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near copies of every document and its links to other texts."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-tokens and unigram tokens of every document."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return counts.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document once lines go that equal an earlier one or, from eight words on, differ from it by one word."""
    left = lines.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"), equal_words=1)
    return left.select("doc_id", "n_lines", "n_removed", F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5"))


OP9_SQL = r"""
WITH raw AS (
  SELECT doc_id, no, line, trim(regexp_replace(line, '[\x20\x09\x0B-\x0D]+', ' ', 'g'), ' ') AS even
  FROM (SELECT doc_id, unnest(range(0, len(string_split(text, chr(10))))) AS no, unnest(string_split(text, chr(10))) AS line FROM documents)
),
lines AS (SELECT *, string_split(even, ' ') AS w, len(string_split(even, ' ')) AS n FROM raw WHERE even <> ''),
first AS (SELECT even, any_value(w) AS w, any_value(n) AS n, min((doc_id, no)) AS place FROM lines GROUP BY even),
long AS (SELECT * FROM first WHERE n >= 8),
keys AS (
  SELECT *, n AS t, 0 AS side, list_slice(w, 1, n // 2) AS half FROM long
  UNION ALL SELECT *, n, 1, list_slice(w, n // 2 + 1, n) FROM long
  UNION ALL SELECT *, n - 1, 0, list_slice(w, 1, (n - 1) // 2) FROM long
  UNION ALL SELECT *, n - 1, 1, list_slice(w, n - (n - 1 - (n - 1) // 2) + 1, n) FROM long
),
pairs AS (
  SELECT DISTINCT a.even, a.w AS wa, b.w AS wb FROM keys a JOIN keys b
  ON a.t = b.t AND a.side = b.side AND a.half = b.half AND b.place < a.place AND abs(a.n - b.n) <= 1
),
near AS (
  SELECT DISTINCT even FROM pairs
  WHERE coalesce(list_position(list_transform(range(1, least(len(wa), len(wb)) + 1), lambda i: wa[i] = wb[i]), false), least(len(wa), len(wb)) + 1) - 1
    + coalesce(list_position(list_transform(range(1, least(len(wa), len(wb)) + 1), lambda i: list_reverse(wa)[i] = list_reverse(wb)[i]), false), least(len(wa), len(wb)) + 1) - 1
    >= greatest(len(wa), len(wb)) - 1
),
gone AS (
  SELECT l.doc_id, l.no FROM lines l JOIN first f ON l.even = f.even LEFT JOIN near ON l.even = near.even
  WHERE near.even IS NOT NULL OR (l.doc_id, l.no) <> f.place
),
left_over AS (
  SELECT r.doc_id, count(*) AS n_lines, count(g.no) AS n_removed,
    coalesce(string_agg(r.line, chr(10) ORDER BY r.no) FILTER (g.no IS NULL), '') AS kept
  FROM raw r LEFT JOIN gone g ON r.doc_id = g.doc_id AND r.no = g.no GROUP BY r.doc_id
)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  md5(coalesce(kept, '')) AS kept_md5
FROM documents d LEFT JOIN left_over l ON d.doc_id = l.doc_id
"""


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest by inner product for every vector whose id is divisible by 20, over all vectors."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return hnsw.search(hnsw.build(vectors), vectors.where(F.col("vec_id") % 20 == 0), k=20)


def _wound_up(doc_id: Column, text: Column) -> Column:
    """The text, for a tenth of the ids (by checksum) with its last words replaced by repeats of some of them."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.floor((n - a) / p).cast("int") + 1))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(tail, F.lit(1), n - a)), " ")).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, the greatest of them, and digests of all and of the text without repeats."""
    docs = table(spark, sf_dir, "documents").select("doc_id", _wound_up(F.col("doc_id"), F.col("text")).alias("text"))
    found = periods.periodic_runs(docs)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[k].cast("string") for k in ("start", "length", "period")]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "greatest.start",
        "greatest.length",
        "greatest.period",
        F.expr("1000 * greatest.length div greatest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every source of a language the other ones by distance, and the 50 words that mark it most."""
    return divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
),
words AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
shares AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (total + 5 * v) AS q FROM kept JOIN langs USING (lang)
),
present AS (SELECT DISTINCT lang, source FROM d),
counts AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
sums AS (SELECT p.lang, p.source, coalesce(sum(n), 0) AS total FROM present p LEFT JOIN counts USING (lang, source) GROUP BY 1, 2),
own AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (s.total + 5 * l.v) AS p
  FROM sums s JOIN kept k ON s.lang = k.lang JOIN langs l ON s.lang = l.lang
  LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM own a JOIN own b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3
),
results AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM present a JOIN present b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT o.lang, o.source, 'term', o.term, p - q FROM own o JOIN shares s ON o.lang = s.lang AND o.term = s.term WHERE o.n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM results QUALIFY part = 'pair' OR rank <= 50
"""


def op13_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal texts of every document, and which of them stays."""
    return contents.exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(length(text), 0) AS n,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents
),
ranked AS (
  SELECT *, first_value(doc_id) OVER best AS keep_id, row_number() OVER best AS place, count(*) OVER (PARTITION BY content) AS size
  FROM d WINDOW best AS (PARTITION BY content ORDER BY n DESC, doc_id NULLS LAST, r)
)
SELECT doc_id, keep_id, CAST(size AS BIGINT) AS group_size, place = 1 AS kept, sha256(content) AS text_sha256 FROM ranked
"""


def byte_bpe() -> tuple[str, str, str]:
    """Rank file, tokenizer file and splitting pattern of the public byte-level vocabulary."""
    import public_tokenizers

    return (
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
    )


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_suffix_array_dedup,
    op2_best_fit_packing,
    op3_near_passages,
    op4_mixing_sources,
    op5_quality_rules,
    op6_secret_scans,
    op7_near_duplicates,
    op8_token_counts,
    op9_line_dedup,
    op10_nearest_neighbours,
    op11_periodic_runs,
    op12_source_divergence,
    op13_content_sort,
)}
SQL: dict[str, str] = {"op4_mixing_sources": OP4_SQL, "op5_quality_rules": OP5_SQL, "op9_line_dedup": OP9_SQL, "op12_source_divergence": OP12_SQL, "op13_content_sort": OP13_SQL}
