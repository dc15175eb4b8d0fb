"""The operators as named queries over the test tables, with SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.llm import (
    byte_bpe,
    collocations,
    langid,
    licence_scan,
    line_rules,
    merkle,
    minhash,
    pfair_mix,
    quality_crf,
    secret_scan,
    substring_dedup,
    topk,
    vector_codes,
)
from candlemill.llm.common import crc_mod

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            SQL[query.__name__] = sql
        return query

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_WORDS_SQL = (
    "list_filter(regexp_split_to_array(coalesce({text}, ''), '[\\x20\\x09-\\x0D]+'), "
    "lambda w: w <> '')"
)

# A match between two marks, so that splitting at the first mark tells where
# matches begin; the marks are private-use characters.
_SECRET_PIECES = """
  SELECT doc_id, {order} AS kind_order, '{kind}' AS kind, {least} AS ok, piece, first,
         strpos(piece, chr(57345)) - 1 AS n
  FROM (
    SELECT doc_id, unnest(pieces[2:]) AS piece,
           unnest(list_transform(range(2, len(pieces) + 1), lambda k:
             list_sum(list_transform(pieces[1:k - 1], lambda p:
               length(replace(p, chr(57345), '')))))) AS first
    FROM (SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '({pattern})',
            chr(57344) || '\\1' || chr(57345), 'g'), chr(57344)) AS pieces FROM documents)
    WHERE len(pieces) > 1)
"""
_NAMES = "|".join(
    "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in name)
    for name in ("password", "passwd", "secret", "token", "api_?key")
)
_ASSIGN_SQL = rf"""((?:{_NAMES})["'']?\x20*[:=]\x20*["'']?)([A-Za-z0-9+/_.=-]+)"""
_MORE_SECRETS = (
    ("private",
     r"-----BEGIN\x20[A-Z\x20]*PRIVATE\x20KEY-----"
     r"(?:[A-Za-z0-9+/=\x09\x0A\x0D\x20]*-----END\x20[A-Z\x20]*PRIVATE\x20KEY-----)?", ""),
    ("github", "gh[oprsu]_[A-Za-z0-9]+", "{36,}"),
    ("slack", "xox[abeoprs]-[A-Za-z0-9-]+", "{10,}"),
    ("jwt", "eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", "{8,}"),
    ("bearer", r"[Bb][Ee][Aa][Rr][Ee][Rr]\x20+[A-Za-z0-9._~+/=-]+", "{20,}"),
)


def _more_secrets() -> str:
    """The further kinds; a match is dropped if its parts are shorter than the least length."""
    return " UNION ALL ".join(
        _SECRET_PIECES.format(
            order=k, kind=kind, pattern=pattern,
            least="regexp_matches(left(piece, strpos(piece, chr(57345))), '^"
            + (pattern.replace("]+", "]" + least) if least else pattern) + "' || chr(57345))",
        )
        for k, (kind, pattern, least) in enumerate(_MORE_SECRETS, 3)
    )


_SECRET_SQL = """
WITH found AS ({assign} UNION ALL {access} UNION ALL {hex} UNION ALL {more}),
spans AS (
  SELECT doc_id, kind, kind_order, CAST(first AS bigint) AS s, CAST(first + n AS bigint) AS e
  FROM found WHERE ok),
joined AS (
  SELECT doc_id,
         count(*) FILTER (kind = 'assign') AS n_assign,
         count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, kind_order) AS spans,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, kind_order)
           FILTER (kind_order < 3) AS base
  FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM documents LEFT JOIN joined USING (doc_id)
""".format(
    assign=_SECRET_PIECES.format(
        order=0, kind="assign", pattern=_ASSIGN_SQL,
        least="length(regexp_extract(piece, '^" + _ASSIGN_SQL + "', 2)) >= 6",
    ),
    access=_SECRET_PIECES.format(
        order=1, kind="access", pattern="AKIA[A-Z0-9]{16,}", least="true",
    ),
    hex=_SECRET_PIECES.format(
        order=2, kind="hex", pattern="[0-9a-f]{24,}", least="true",
    ),
    more=_more_secrets(),
)


@register(_SECRET_SQL)
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(documents(spark, sf_dir), ["doc_id"])
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secret_scan.span_text(base).cast("binary"), 256).alias("base_sha256"),
        secret_scan.span_text("spans").alias("spans"),
    )


@register()
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encode(
        documents(spark, sf_dir),
        ["doc_id"],
        vocab,
        public_tokenizers.PATTERN,
        outputs=["n_tokens", "ids_sha256", "decoded_sha256"],
    )


@register()
def op5_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare_edits(documents(spark, sf_dir)).select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


# Fixed value: the score from which a document counts as good.
GOOD_FROM = 0.3


@register()
def op7_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_crf.fit(docs, labels, learn=crc_mod("doc_id", 5) != 0)
    return quality_crf.score_documents(docs, model, ["doc_id"]).select(
        "doc_id",
        (crc_mod("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"),
    )


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NEAR_SQL = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, {_WORDS_SQL.format(text=f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")} AS words
  FROM documents),
members AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(words) = 0 THEN []
    WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))
    END) AS shingle FROM worded),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM members GROUP BY doc_id),
linked AS MATERIALIZED (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
    FROM members x JOIN members y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
    GROUP BY x.doc_id, y.doc_id)
  JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 100 * common >= 80 * (s.n + t.n - common)),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.a, linked.b FROM reach JOIN linked ON linked.a = reach.b),
found AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN found USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""


@register(_NEAR_SQL)
def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), width=4)


_REPEATS_SQL = f"""
WITH worded AS MATERIALIZED (
  SELECT doc_id, {_WORDS_SQL.format(text="text")} AS words FROM documents),
windows AS MATERIALIZED (
  SELECT doc_id, first, md5(array_to_string(words[first:first + 49], ' ')) AS key
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS first FROM worded)),
owners AS (SELECT key, min(doc_id) AS owner FROM windows GROUP BY key),
covered AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(range(first, first + 50)) AS place
  FROM windows JOIN owners USING (key) WHERE doc_id > owner),
placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM worded),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
  FROM placed ANTI JOIN covered USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS bigint) AS n_words,
       CAST(len(words) - coalesce(n, 0) AS bigint) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM worded LEFT JOIN kept USING (doc_id)
"""


@register(_REPEATS_SQL)
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(documents(spark, sf_dir)).drop("kept")


@register()
def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = crc_mod("doc_id", 4) == 2
    model = langid.fit(docs, learn=~held_out)
    found = langid.identify(docs, model, ["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@register(
    """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS double)) AS double)) AS part
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(q.part, c.part) AS bigint) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT query_id, vec_id, score, CAST(row_number() OVER (
    PARTITION BY query_id ORDER BY score DESC, vec_id) AS integer) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
)
def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    whole = vectors.select("vec_id", topk.whole_components("embedding").alias("vector"))
    return topk.top_k(whole, F.col("vec_id") % 20 == 0, k=20)


# The schedule is simulated slot by slot over a list with the blocks that each
# source has had; its sources are numbered by name, nulls first.
_MIX_SQL = """
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(length(text), 0) AS size FROM documents),
totals AS (SELECT source, sum(size) AS total FROM sized GROUP BY source),
weights AS (
  SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) AS i,
         1 + CAST(floor(round(1000 * sqrt(total) / sum(sqrt(total)) OVER (), 6)) AS bigint) AS w
  FROM totals),
lists AS (
  SELECT list(w ORDER BY i) AS w, CAST(sum(w) AS bigint) AS period, count(*) AS n FROM weights),
turns(slot, pick, had) AS (
  SELECT CAST(-1 AS bigint), CAST(0 AS bigint), list_transform(w, lambda x: CAST(0 AS bigint))
  FROM lists
  UNION ALL
  SELECT slot, pick, list_transform(range(1, n + 1),
           lambda j: had[j] + CASE WHEN j = pick THEN 1 ELSE 0 END)
  FROM (
    SELECT slot + 1 AS slot, had, n, list_min(list_transform(range(1, n + 1), lambda j:
             CASE WHEN had[j] < w[j] AND (had[j] * period) // w[j] <= slot + 1
                  THEN (((had[j] + 1) * period + w[j] - 1) // w[j]) * 100000 + j
                  ELSE 9000000000000000 END)) % 100000 AS pick
    FROM turns, lists WHERE slot + 1 < period)),
period_slots AS (
  SELECT slot, pick AS i, row_number() OVER (PARTITION BY pick ORDER BY slot) - 1 AS turn
  FROM turns WHERE slot >= 0),
started AS (
  SELECT doc_id, source, CAST(sum(size) OVER (
           PARTITION BY source ORDER BY md5(CAST(doc_id AS varchar)), doc_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS bigint) AS start
  FROM sized)
SELECT doc_id, s.source, w AS weight, start, start // 20000 AS block,
       ((start // 20000) % w * period) // w + (start // 20000) // w * period AS release,
       (((start // 20000) % w + 1) * period + w - 1) // w + (start // 20000) // w * period
         AS deadline,
       p.slot + (start // 20000) // w * period AS slot
FROM started s
JOIN weights ON s.source IS NOT DISTINCT FROM weights.source
JOIN period_slots p ON p.i = weights.i AND p.turn = (start // 20000) % w
CROSS JOIN (SELECT period FROM lists)
"""


@register(_MIX_SQL)
def op1_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(
        "doc_id", "source", F.coalesce(F.length("text"), F.lit(0)).alias("chars")
    )
    return pfair_mix.mix(docs, F.col("chars"), block_size=20_000).drop("chars")


@register()
def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return licence_scan.licences(docs, licence_scan.fit(docs))


_LINES_SQL = rf"""
WITH worded AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text,
         {_WORDS_SQL.format(text="text")} AS words FROM documents),
windows AS MATERIALIZED (
  SELECT row, first, count(*) OVER (PARTITION BY row, key) AS times
  FROM (SELECT row, first, words[first:first + 7] AS key
        FROM (SELECT row, words, unnest(range(1, len(words) - 6)) AS first FROM worded))),
repeated AS (
  SELECT row, count(DISTINCT place) AS n FROM (
    SELECT row, unnest(range(first, first + 8)) AS place FROM windows WHERE times > 1) GROUP BY row),
lines AS MATERIALIZED (
  SELECT row, source, md5(text) AS copy, raw, len(parts) AS words,
         regexp_replace(translate(array_to_string(parts, ' '), '{_UPPER}', '{_UPPER.lower()}'),
                        '[0-9]', '0', 'g') AS line
  FROM (SELECT row, source, text, raw, {_WORDS_SQL.format(text="raw")} AS parts
        FROM (SELECT row, source, text, unnest(string_split(text, chr(10))) AS raw FROM worded))
  WHERE len(parts) > 0),
copied AS (SELECT row, count(*) - count(DISTINCT raw) AS n FROM lines GROUP BY row),
hosts AS (SELECT source, count(DISTINCT md5(text)) AS n FROM worded GROUP BY source),
common AS MATERIALIZED (
  SELECT c.source, c.line FROM (
    SELECT source, line, count(DISTINCT copy) AS n FROM lines GROUP BY source, line) c
  JOIN hosts h ON c.source IS NOT DISTINCT FROM h.source
  WHERE c.n >= 10 AND 100 * c.n > 10 * h.n),
lost AS (
  SELECT row, count(DISTINCT l.line) AS n_lines, sum(words) AS n_words
  FROM lines l JOIN common c ON l.line = c.line AND l.source IS NOT DISTINCT FROM c.source
  GROUP BY row),
measured AS (
  SELECT doc_id, CAST(len(words) AS bigint) AS n_words,
         CAST(length(array_to_string(words, '')) AS bigint) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS bigint) AS n_symbols,
         coalesce(copied.n, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words,
         coalesce(lost.n_lines, 0) AS n_common_lines,
         CAST(coalesce(lost.n_words, 0) AS bigint) AS n_common_words
  FROM worded LEFT JOIN copied USING (row) LEFT JOIN repeated USING (row) LEFT JOIN lost USING (row)),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         n_words - n_common_words AS n_left FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       n_common_lines, n_common_words,
       NOT base_failed AND n_left >= 20 AND 100 * n_left >= 30 * n_words AS kept
FROM judged
"""


@register(_LINES_SQL)
def op11_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judge(documents(spark, sf_dir))


def _codes_sql() -> str:
    """Assignment and averaging, written out for each round."""
    nearest = """
a{n} AS MATERIALIZED (
  SELECT vec_id, part, v, entry, distance FROM (
    SELECT x.vec_id, x.part, x.v, b.entry,
           list_inner_product(x.v, x.v) - 2 * list_inner_product(x.v, b.v)
             + list_inner_product(b.v, b.v) AS distance,
           row_number() OVER (PARTITION BY x.vec_id, x.part ORDER BY
             list_inner_product(b.v, b.v) - 2 * list_inner_product(x.v, b.v), b.entry) AS place
    FROM parts x JOIN b{n} b ON x.part = b.part) WHERE place = 1)"""
    averaged = """
b{m} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v
  FROM b{n} b LEFT JOIN (
    SELECT part, entry, list(floor(total / n) ORDER BY place) AS v FROM (
      SELECT part, entry, place, sum(x) AS total, count(*) AS n FROM (
        SELECT part, entry, unnest(v) AS x, unnest(range(len(v))) AS place FROM a{n})
      GROUP BY part, entry, place) GROUP BY part, entry) m
  ON b.part = m.part AND b.entry = m.entry)"""
    rounds = [
        step for n in range(4) for step in (nearest.format(n=n), averaged.format(n=n, m=n + 1))
    ]
    return """
WITH whole AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS entry,
         list_transform(embedding, lambda x: floor(1024 * CAST(x AS double))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, label, entry, part, v[part * len(v) // 4 + 1:(part + 1) * len(v) // 4] AS v
  FROM whole, range(4) r(part)),
b0 AS MATERIALIZED (SELECT part, entry, v FROM parts WHERE entry < 256),""" + ",".join(
        [*rounds, nearest.format(n=4)]
    ) + """,
coded AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
         CAST(sum(distance) AS bigint) AS error FROM a4 GROUP BY vec_id),
books AS (
  SELECT sha256(string_agg(text, ',' ORDER BY part, entry)) AS digest FROM (
    SELECT part, entry, array_to_string(list_transform(v, lambda x: CAST(x AS bigint)), ',') AS text
    FROM b4))
SELECT vec_id, code, error,
       CAST(sum(error) OVER (PARTITION BY label) AS bigint) AS label_error,
       digest AS codebooks_sha256
FROM coded JOIN whole USING (vec_id), books
"""


@register(_codes_sql())
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


_PHRASES_SQL = rf"""
WITH pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
          '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
totals AS (SELECT lang, CAST(sum(len(words)) AS bigint) AS n FROM pieces GROUP BY lang),
found AS MATERIALIZED (
  SELECT lang, array_to_string(words[first:first + size - 1], ' ') AS phrase, size, count(*) AS f
  FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS first
        FROM pieces, range(1, 4) s(size))
  GROUP BY ALL HAVING f >= 10),
cuts AS (
  SELECT lang, phrase, size, f AS a, k, array_to_string(words[:k], ' ') AS head,
         array_to_string(words[k + 1:], ' ') AS tail
  FROM (SELECT *, string_split(phrase, ' ') AS words, unnest(range(1, size)) AS k
        FROM found WHERE size > 1)),
scored AS (
  SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r,
         CAST(CAST(1000000 AS hugeint) * c.a * c.a // (CAST(l.f AS hugeint) * r.f) AS bigint) AS score
  FROM cuts c JOIN found l ON l.lang = c.lang AND l.phrase = head
  JOIN found r ON r.lang = c.lang AND r.phrase = tail),
best AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, unnest([words[:2], words[2:]]) AS words, f
  FROM (SELECT lang, string_split(phrase, ' ') AS words, f FROM found WHERE size = 3)),
inside AS (
  SELECT lang, array_to_string(words, ' ') AS phrase, max(f) AS f FROM longer GROUP BY ALL),
ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE i.f IS NULL OR 100 * i.f < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@register(_PHRASES_SQL)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))
