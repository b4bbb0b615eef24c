"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm._common import documents


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paddock.llm.bpe import encode_documents
    return encode_documents(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paddock.llm.exact_dedup import exact_duplicates
    return exact_duplicates(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paddock.llm.ngram_join import classes
    return classes(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paddock.llm.packing import pack_documents
    return pack_documents(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paddock.llm.language_id import identify
    return identify(documents(spark, sf_dir))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paddock.llm.quality import rules
    return rules(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paddock.llm.pii import find
    return find(documents(spark, sf_dir))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paddock.llm.substring_dedup import passages
    return passages(documents(spark, sf_dir)).drop("row")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paddock.llm.warc import normalise, read_archives, write_archives
    archives = write_archives(documents(spark, sf_dir, "pages"))
    return read_archives(normalise(archives)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# The tools that op10 derives calls of; the third's calls carry an argument of a wrong type.
TOOLS = {"count": {"exact": ("boolean", True), "text": ("string", True)},
         "lookup": {"key": ("string", True)},
         "search": {"limit": ("integer", False), "query": ("string", True)}}


def tool_messages(conversations: DataFrame) -> DataFrame:
    """The conversations as exchanges with tools: a user's turn becomes a call that waits
    for the previous user's (in every seventh conversation for the next one's), the turn
    after it the call's result; other messages stay."""
    name = F.element_at(F.array(*map(F.lit, sorted(TOOLS))),
                        (F.pmod(F.col("conv_id") + F.col("turn"), F.lit(3)) + 1).cast("int"))
    arguments = (F.when(name == "count", F.to_json(F.struct("text", F.lit("yes").alias("exact"))))
                 .when(name == "lookup", F.to_json(F.struct(F.col("text").alias("key"))))
                 .otherwise(F.to_json(F.struct(F.col("text").alias("query"),
                                               F.col("turn").alias("limit")))))
    ident = lambda turn: F.concat_ws("-", F.col("conv_id"), turn)
    after = (F.when(F.pmod("conv_id", F.lit(7)) == 0, F.array(ident(F.col("turn") + 2)))
             .when(F.col("turn") >= 2, F.array(ident(F.col("turn") - 2)))
             .otherwise(F.array().cast("array<string>")))
    call = F.to_json(F.struct(F.array(F.struct(name.alias("name"), ident(F.col("turn")).alias("id"),
                                               arguments.alias("arguments"),
                                               after.alias("after"))).alias("tool_calls")))
    answer = F.to_json(F.struct(ident(F.col("turn") - 1).alias("tool_call_id"),
                                F.coalesce("text", F.lit("")).alias("content")))
    return conversations.select(
        "conv_id", "turn",
        F.when(F.col("role") == "user", "assistant").when(F.col("role") == "assistant", "tool")
        .otherwise(F.col("role")).alias("role"),
        F.when(F.col("role") == "user", call).when(F.col("role") == "assistant", answer)
        .otherwise(F.col("text")).alias("text"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paddock.llm.chat import format_chats
    return format_chats(tool_messages(documents(spark, sf_dir, "conversations")), TOOLS)


def _with_loops(docs: DataFrame) -> DataFrame:
    """doc_id and text; in a tenth of the texts (by the id's checksum) the words from some
    word on repeat a period."""
    n = F.size("words").cast("long")
    a = F.pmod("g", F.greatest(n, F.lit(1)))
    p = F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + F.col("g") % 8))
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a").cast("int") + 1, F.col("p").cast("int")),
                                    F.ceil((n - F.col("a")) / F.col("p")).cast("int")))
    repeated = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")),
                                     F.slice(tail, F.lit(1), (n - F.col("a")).cast("int"))), " ")
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(F.when(F.col("h") % 10 == 0, F.col("text")), r"[\x20\x09-\x0D]+"),
                     lambda w: w != "")
    return (docs.select("doc_id", "text", h.alias("h"))
            .withColumns({"g": F.floor(F.col("h") / 10), "words": words})
            .withColumn("a", a).withColumn("p", p)
            .select("doc_id", F.when(n > 0, repeated).otherwise(F.col("text")).alias("text")))


def periodic(docs: DataFrame) -> DataFrame:
    from paddock.llm.periodic_runs import find_runs
    listed = F.transform("runs", lambda r: F.concat(r.start, F.lit(","), r.length, F.lit(","),
                                                    r.period, F.lit("\n")))
    # by start and period: the first of the greatest quotients stays
    best = F.aggregate("runs", F.get("runs", 0), lambda most, r: F.when(
        r.length * most.period > most.length * r.period, r).otherwise(most))
    return find_runs(_with_loops(docs)).withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length",
        "best.period", F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic(documents(spark, sf_dir))


def op12_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paddock.llm.licence_scan import scan
    found = scan(documents(spark, sf_dir))
    base = found.withColumn("base", F.filter("matches", lambda m: m.kind == "base"))
    names = lambda c: F.array_join(F.array_sort(F.array_distinct(F.col(f"{c}.label"))), ",")
    return base.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").alias("first_word"), F.array_max("base.start").alias("last_word"),
        names("base").alias("base_labels"), names("matches").alias("labels"),
        F.coalesce(F.array_max("matches.score"), F.lit(0.0)).alias("score"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from paddock.llm.whitening import whiten
    return whiten(documents(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_ngram_join": op3_ngram_join,
    "op4_packing": op4_packing,
    "op5_language_id": op5_language_id,
    "op6_quality": op6_quality,
    "op7_pii": op7_pii,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_warc": op9_warc,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_licence_scan": op12_licence_scan,
    "op13_whitening": op13_whitening,
}

ORACLES = {
    "op10_chat_formatting": """
        WITH c AS (SELECT conv_id, turn, role, text,
                          conv_id || '-' || turn AS own, conv_id || '-' || (turn - 1) AS asked,
                          ['count', 'lookup', 'search'][(conv_id + turn) % 3 + 1] AS tool,
                          conv_id % 7 = 0 AS backward
                   FROM conversations),
             u AS (SELECT conv_id, turn, backward, EXISTS (
                              SELECT 1 FROM c b WHERE b.conv_id = a.conv_id AND b.turn = a.turn + 1
                                                  AND b.role = 'assistant') AS answered
                   FROM c a WHERE role = 'user'),
             -- unbroken chains of users' turns two apart: a backward call waits for all after it
             gaps AS (SELECT *, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) = turn + 2 AS more
                      FROM u),
             ends AS (SELECT *, min(CASE WHEN more THEN NULL ELSE turn END) OVER (
                                    PARTITION BY conv_id ORDER BY turn
                                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS last_turn
                      FROM gaps),
             calls AS (SELECT conv_id, turn, answered,
                              CASE WHEN backward THEN last_turn ELSE turn END AS place,
                              CASE WHEN backward THEN (last_turn - turn) // 2 ELSE 0 END AS level
                       FROM ends)
        SELECT c.conv_id, c.turn, CAST(1 AS BIGINT) AS idx, 'assistant' AS role, 'call' AS kind,
               own AS call_id, CASE WHEN answered THEN 'linked' ELSE 'unanswered' END AS status,
               tool <> 'count' AS valid,
               CASE WHEN tool = 'count' THEN 'not boolean: exact' ELSE '' END AS errors,
               k.place, k.level, CAST(1 AS BIGINT) AS step,
               json_object('role', 'assistant', 'tool_calls', json_array(json_object(
                   'arguments', CASE tool WHEN 'count' THEN json_object('exact', 'yes', 'text', text)
                                          WHEN 'lookup' THEN json_object('key', text)
                                          ELSE json_object('limit', c.turn, 'query', text) END,
                   'id', own, 'name', tool)))::VARCHAR AS message_json
        FROM c JOIN calls k ON c.conv_id = k.conv_id AND c.turn = k.turn WHERE role = 'user'
        UNION ALL
        SELECT c.conv_id, c.turn, 0, 'tool', 'result', asked,
               CASE WHEN k.turn IS NULL THEN 'orphan' ELSE 'linked' END, NULL, NULL,
               greatest(c.turn, coalesce(k.place, c.turn)), coalesce(k.level, 0), 2,
               json_object('content', coalesce(text, ''), 'role', 'tool', 'tool_call_id', asked)::VARCHAR
        FROM c LEFT JOIN calls k ON c.conv_id = k.conv_id AND c.turn = k.turn + 1 WHERE role = 'assistant'
        UNION ALL
        SELECT conv_id, turn, 0, role, 'message', NULL, 'message', NULL, NULL, turn, 0, 0,
               json_object('content', coalesce(text, ''), 'role', role)::VARCHAR
        FROM c WHERE role NOT IN ('user', 'assistant')""",
    "op9_warc": """
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN 'revisit'
                    ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id < last_id THEN last_id END AS refers_to
        FROM (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                     sha1(coalesce(html, '')) AS payload_digest,
                     max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last_id
              FROM pages)""",
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
}
