"""One query per operator over its whole given table, with SQL where DuckDB can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tableload.llm import langid
from tableload.llm.chat import rendered
from tableload.llm.exact import exact_duplicates
from tableload.llm.jaccard import near_duplicates
from tableload.llm.lexical import ranked
from tableload.llm.packing import packed_documents
from tableload.llm.pii import personal_data
from tableload.llm.quality import judged
from tableload.llm.repair import damaged, repaired
from tableload.llm.spm import encoded, token_counts
from tableload.llm.toxicity import THRESHOLD, scored, train
from tableload.llm.warc import archived_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query(
    """
    WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
    FROM n WINDOW w AS (PARTITION BY t)
    """
)
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(given(spark, sf_dir, "documents")).drop("raw_sha256")


@query(
    r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
        FROM documents
    ), s AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
            ELSE list_transform(range(1, len(ws) - 2), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3]) END) AS shingle
        FROM w
    ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    both_have AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
    ), links AS (
        SELECT a, b FROM both_have JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
    ), reach AS (
        SELECT doc_id AS node, doc_id AS other FROM documents UNION SELECT node, b FROM reach JOIN links ON a = other
    )
    SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(other) AS component_id
    FROM documents d JOIN reach ON node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
    """
)
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(given(spark, sf_dir, "documents"), size=4, similarity=85).drop("class_id")


@query(
    r"""
    WITH w AS (
        SELECT doc_id, lang, source, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
               len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS n_symbols
        FROM documents
    ), starts AS (
        SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w
    ), windows AS (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[i:i + 7], ' ')) AS c FROM starts
    ), covered AS (
        SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM windows WHERE c > 1) GROUP BY 1
    ), m AS (
        SELECT w.doc_id, lang, source, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
               n_symbols, len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
        FROM w LEFT JOIN covered c ON c.doc_id = w.doc_id
    ), b AS (
        SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
               {'symbols_pm': 1000 * n_symbols // greatest(word_chars, 1), 'dup_lines_pm': 1000 * n_dup_lines // greatest(n_lines, 1),
                'repeat_pm': 1000 * n_repeat_words // greatest(n_words, 1), 'word_length_pm': 1000 * word_chars // greatest(n_words, 1)} AS pm
        FROM m
    ), measured AS (
        SELECT *, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS bucket FROM (
            SELECT doc_id, lang, source, 'symbols_pm' AS measure, pm.symbols_pm AS v, 1000 / greatest(word_chars, 1) AS unit, base_failed FROM b
            UNION ALL SELECT doc_id, lang, source, 'dup_lines_pm', pm.dup_lines_pm, 1000 / greatest(n_lines, 1), base_failed FROM b
            UNION ALL SELECT doc_id, lang, source, 'repeat_pm', pm.repeat_pm, 16000 / greatest(n_words, 1), base_failed FROM b
            UNION ALL SELECT doc_id, lang, source, 'word_length_pm', pm.word_length_pm, pm.word_length_pm / greatest(n_words, 1), base_failed FROM b
        )
    ), buckets AS (
        SELECT lang, source, measure, bucket, count(*) AS n FROM measured WHERE NOT base_failed GROUP BY ALL
    ), merged AS (
        SELECT 1 AS level, lang, source, measure, bucket, n FROM buckets
        UNION ALL SELECT 2, lang, NULL, measure, bucket, sum(n) FROM buckets GROUP BY ALL
        UNION ALL SELECT 3, NULL, NULL, measure, bucket, sum(n) FROM buckets GROUP BY ALL
    ), ranked AS (
        SELECT *, sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY bucket) AS upto,
               sum(n) OVER (PARTITION BY level, lang, source, measure) AS size
        FROM merged
    ), q AS (
        SELECT level, lang, source, measure, any_value(size) AS size, min(bucket) FILTER (upto * 100 >= size * 25) AS q25,
               min(bucket) FILTER (upto * 100 >= size * 50) AS q50, min(bucket) FILTER (upto * 100 >= size * 75) AS q75,
               min(bucket) FILTER (upto * 100 >= size * CASE WHEN measure IN ('dup_lines_pm', 'repeat_pm') THEN 98 ELSE 75 END) AS tail
        FROM ranked GROUP BY ALL
    ), f AS (
        SELECT level, lang, source, measure, size, q50, tail, 4 * (q75 + (1::BIGINT << greatest(length(bin(q75)) - 6, 0)) - 1 - q25) AS spread FROM q
    ), chosen AS (
        SELECT d.doc_id, d.measure, d.bucket, d.unit, arg_min({'lo': f.q50 - f.spread, 'hi': greatest(f.q50 + f.spread, f.tail)}, f.level) AS t
        FROM measured d JOIN f ON f.measure = d.measure AND (f.level = 3 OR f.size >= 100
            AND f.lang IS NOT DISTINCT FROM d.lang AND (f.level = 2 OR f.source IS NOT DISTINCT FROM d.source))
        GROUP BY ALL
    ), verdicts AS (
        SELECT doc_id, bool_and(bucket - unit <= t.hi AND (measure <> 'word_length_pm' OR bucket + unit >= t.lo)) AS fine FROM chosen GROUP BY 1
    )
    SELECT b.doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND coalesce(fine, TRUE) AS kept
    FROM b LEFT JOIN verdicts v ON v.doc_id = b.doc_id
    """
)
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(given(spark, sf_dir, "documents")).drop("lang", "source", "n_lines", "level")


@query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = train(docs, given(spark, sf_dir, "labels"), learn=fold != 1)
    rows = scored(docs.select("doc_id", "text"), model)
    return rows.select(
        "doc_id", (fold == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


@query()
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(given(spark, sf_dir, "documents"))


@query(
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    hashed AS (SELECT page_id, h, sha1(h) AS hex, min(page_id) OVER (PARTITION BY h) AS first FROM p),
    bits AS (
        SELECT page_id, h, first, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31 AS INT), 1), '' ORDER BY i) AS digest
        FROM hashed, range(32) t(i) GROUP BY ALL
    )
    SELECT page_id, octet_length(encode(h)) AS payload_bytes, digest AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to
    FROM bits
    """
)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = archived_pages(given(spark, sf_dir, "pages"))
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents")
    rows = encoded(docs.select("doc_id", "text"), carry_text=True)
    spaced = F.translate(F.coalesce("text", F.lit("")), "\u2581", " ")  # the marker is a space to the tokenizer
    return rows.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
        (F.col("decoded") == spaced).alias("round_trip"),
    )


@query()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(given(spark, sf_dir, "documents"))


@query()
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    filters = langid.train(docs, learn=fold != 2)
    rows = langid.identified(docs, filters)
    return rows.select("doc_id", (fold == 2).alias("held_out"), "lang_pred", "score")


@query(
    """
    WITH t AS (
        SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        WHERE conv_id IS NOT NULL AND turn IS NOT NULL
    ), c AS (
        SELECT conv_id, list({'turn': turn, 'content': sha256(length(role) || ':' || role || text), 'role': role, 'text': text}
            ORDER BY turn, sha256(length(role) || ':' || role || text)) AS turns
        FROM t GROUP BY 1
    ), k AS (SELECT conv_id, turns, len(turns) AS n, list_transform(turns, lambda x: x.turn || x.content) AS keys FROM c),
    proper AS (SELECT DISTINCT keys[1:i] AS keys FROM (SELECT keys, unnest(range(1, n)) AS i FROM k)),
    whole AS (SELECT keys, min(conv_id) AS conv_id, count(*) AS n_copies FROM k GROUP BY 1)
    SELECT w.conv_id, CAST(x.turn // 512 AS BIGINT) AS part, CAST(k.n AS BIGINT) AS n_turns, w.n_copies,
           string_agg('<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10), '' ORDER BY x.turn, x.content) AS chat
    FROM whole w JOIN k ON k.conv_id = w.conv_id, unnest(k.turns) u(x)
    WHERE w.keys NOT IN (SELECT keys FROM proper) GROUP BY ALL
    """
)
def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered(given(spark, sf_dir, "conversations"))


@query(
    r"""
    WITH t AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
    ), q AS (
        SELECT item_id, term, count(*) AS c FROM (
            SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
        ) GROUP BY ALL
    ), n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY 1),
    g AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM n),
    f AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, g GROUP BY term, docs),
    s AS (
        SELECT item_id, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // total)))) AS BIGINT) AS score
        FROM f JOIN n USING (doc_id) JOIN w USING (term) JOIN q USING (term), g GROUP BY ALL
    )
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
    FROM s WHERE score > 0 QUALIFY rank <= 10
    """
)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(given(spark, sf_dir, "documents"), given(spark, sf_dir, "benchmark"))


@query()
def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(given(spark, sf_dir, "documents"))


def _repair_sql() -> str:
    """The dynamic program turn by turn: four states, each with its least cost and first letters."""

    def plus(state: str, cost: str, letters: str) -> str:
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || {letters}}}"

    def least(*ways: str) -> str:
        return f"list_min([{', '.join(ways)}])"

    to_user = least("v.u", *(plus(f"v.{p}", "2", "'I'") for p in "zsa"))
    to_assistant = least("v.a", plus("v.u", "2", "'I'"), plus("v.z", "4", "'II'"), plus("v.s", "4", "'II'"))
    # where a user turn may follow: nothing, a system turn or an assistant turn
    before_user = least("v.z", "v.s", to_assistant)

    def turned(before: str, initial: str) -> str:
        cost = f"CASE WHEN r.gone THEN 1000000000 ELSE r.short + CASE WHEN r.i = '{initial}' THEN 0 ELSE 2 END END"
        return plus(before, cost, f"CASE WHEN r.i = '{initial}' THEN 'K' ELSE 'R' END")

    only_system = plus("v.z", "CASE WHEN r.gone OR r.i <> 's' THEN 1000000000 ELSE r.short END", "'K'")
    step = ", ".join(
        f"'{state}': {least(*ways)}"
        for state, ways in {
            "z": [plus("v.z", "3", "'D'")],
            "s": [plus("v.s", "3", "'D'"), only_system],
            "u": [plus(to_user, "3", "'D'"), turned(before_user, "u")],
            "a": [plus(to_assistant, "3", "'D'"), turned(to_user, "a")],
        }.items()
    )
    far = "{'c': CAST(1000000000000 AS BIGINT), 'a': ''}"
    crc = "CASE WHEN i % 8 = 0 THEN xor(c, ascii(substr(k, i // 8 + 1, 1))::BIGINT) ELSE c END"
    return rf"""
    WITH raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
    hit AS (
        SELECT *, xor(4294967295, list_reduce(range(0, 8 * length(k)), lambda c, i: xor(({crc}) >> 1, CASE WHEN (({crc}) & 1) = 1 THEN 3988292384 ELSE 0 END), 4294967295::BIGINT)) % 20 AS h
        FROM raw
    ), after AS (
        SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role,
               CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(CASE h WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
        FROM hit
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text), copy) AS p,
               regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS mark, left(role, 1) AS i
        FROM after
    ), found AS (
        SELECT *, mark = '' AS blank, mark <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 AS duplicate,
               i || lead(i) OVER (PARTITION BY conv_id ORDER BY p) AS pair
        FROM placed
    ), turns AS (SELECT *, NOT blank AND NOT duplicate AND mark NOT IN ('.', '!', '?') AS truncated FROM found),
    counted AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(duplicate) AS duplicate,
               count_if(truncated) AS truncated, count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal,
               list({{'i': i, 'gone': blank OR duplicate, 'short': truncated::BIGINT}} ORDER BY p) AS rows
        FROM turns GROUP BY conv_id
    ), solved AS (
        SELECT * EXCLUDE (rows), list_reduce(rows, lambda v, r: {{{step}}}, {{'z': {{'c': 0::BIGINT, 'a': ''}}, 's': {far}, 'u': {far}, 'a': {far}}}) AS v FROM counted
    ), best AS (SELECT * EXCLUDE (v), {least("v.z", "v.a", plus("v.u", "2", "'I'"), plus("v.s", "4", "'II'"))} AS b FROM solved),
    letters AS (SELECT conv_id, unnest(range(1, length(b.a) + 1)) AS n, b.a[n] AS letter FROM best),
    walked AS (
        SELECT *, count_if(letter <> 'I') OVER w AS p, count_if(letter <> 'D') OVER w AS o FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY n)
    ), kept AS (
        SELECT w.conv_id, n, o, letter, t.role, CASE letter WHEN 'I' THEN '' ELSE t.text END AS text,
               bool_or(letter = 'K' AND o = 1 AND t.i = 's') OVER (PARTITION BY w.conv_id) AS system
        FROM walked w JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.p = greatest(w.p, 1) WHERE letter <> 'D'
    ), written AS (
        SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (o - system::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY n)) AS s
        FROM kept GROUP BY 1
    ), ids AS (SELECT DISTINCT conv_id FROM conversations)
    SELECT ids.conv_id, {', '.join(f'CAST(coalesce({n}, 0) AS BIGINT) AS {n}' for n in ('gaps', 'blank', 'duplicate', 'truncated', 'illegal'))},
           CAST(coalesce(b.c, 0) AS BIGINT) AS cost, coalesce(b.a, '') AS audit, coalesce(s, sha256('')) AS repaired_sha256
    FROM ids LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN written ON written.conv_id IS NOT DISTINCT FROM ids.conv_id
    """


@query(_repair_sql())
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(damaged(given(spark, sf_dir, "conversations")))
