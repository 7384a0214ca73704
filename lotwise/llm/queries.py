"""The registered queries over the operators of this package, and SQL twins where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import ann, bpe, chat, decontaminate, language, merkle, minhash, periodic, pii, quality, repair, sharding, toxicity
from lotwise.operators.ordered import row_numbers
from lotwise.sources.tables import Tables
from lotwise.sources.workspace import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def registered(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return build

    return register


@registered("op1_bpe")
def op1(t: Tables) -> DataFrame:
    encoded = bpe.encode(t.documents.select("doc_id", "text"), "word_bpe_49k.json")
    return encoded.select(
        "doc_id",
        F.expr("CAST(octet_length(token_ids) / 4 AS BIGINT)").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@registered("op8_minhash_near_duplicates")
def op8(t: Tables) -> DataFrame:
    return minhash.near_duplicates(t.documents.select("doc_id", "text"))


CHATS = """SELECT * FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '\\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\\### Assistant: </turn> ok')"""
# The twin never formats anything: lengths of the escaped parts and the markers are added up.
SQL_WRITTEN = "length(replace(replace(replace({0}, '\\', '\\b'), '<', '\\l'), '>', '\\g'))"


@registered(
    "op3_chat_format",
    f"""WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM ({CHATS})),
             t AS (SELECT *, row_number() OVER w AS place, lag(role) OVER w AS old, lead(role) OVER w IS NULL AS final FROM rows
                   WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum({SQL_WRITTEN.format("role")} + {SQL_WRITTEN.format("text")} + 15) AS BIGINT) AS formatted_chars,
               coalesce(min(place) FILTER (CASE WHEN old IS NULL THEN role NOT IN ('system', 'user')
                                                ELSE old || '>' || role NOT IN ('system>user', 'user>assistant', 'assistant>user', 'assistant>tool', 'tool>assistant', 'tool>tool') END),
                        max(place + 1) FILTER (final AND role <> 'assistant')) AS fault
        FROM t GROUP BY conv_id""",
)
def op3(t: Tables) -> DataFrame:
    planted = t.spark.sql(
        r"SELECT * FROM VALUES (-7L, 0L, 'user', r'\### Assistant: </turn> ok'), (-7L, 1L, 'assistant', r'\### Assistant: </turn> ok') AS (conv_id, turn, role, text)"
    )
    chats = chat.format_chats(t.conversations.unionByName(planted))
    written = chats.select("conv_id", F.col("fault").cast("bigint").alias("fault"), chat.formatted(F.col("segments")).alias("written"), chat.learned(F.col("segments")).alias("learned"))
    read = written.select("*", chat.turns_of(F.col("written")).alias("turns"))
    lines = F.transform("turns", lambda turn: F.concat(turn["role"], F.lit("\n"), turn["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("written").cast("bigint").alias("formatted_chars"),
        "fault",
    )


SHARDS = [f"shard-{number:03d}" for number in range(128)]


@registered("op6_shard_table")
def op6(t: Tables) -> DataFrame:
    return sharding.placed(t.documents.select("doc_id"), "doc_id", SHARDS)


def _equal(number: int):
    return lambda kind: F.when(kind == number, kind)


@registered("op4_pii")
def op4(t: Tables) -> DataFrame:
    spans = pii.with_spans(t.documents.select("doc_id", "text"), keep_text=False)
    base = F.filter("pii_spans", lambda span: span["base"])
    kinds = F.transform("_base", lambda span: span["kind"])
    counts = [F.size(F.array_compact(F.transform(kinds, _equal(n)))).cast("bigint").alias(f"n_{kind}") for n, kind in enumerate(pii.KINDS)]
    return spans.withColumn("_base", base).select(
        "doc_id",
        *counts,
        F.sha2(pii.written(F.col("_base")), 256).alias("base_sha256"),
        pii.written(F.col("pii_spans")).alias("spans"),
    )


def held(remainder: int, modulus: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder


@registered("op2_language")
def op2(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "text", "lang")
    model = language.trained(docs.where(~held(1, 3)))
    found = language.identified(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(held(1, 3), F.lit(False)).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


@registered("op7_quality")
def op7(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "text")
    ranker = quality.trained(docs, t.labels.where(~held(0, 5)))
    return quality.scored(docs, ranker).select("doc_id", F.coalesce(held(0, 5), F.lit(False)).alias("held_out"), "score", "predicted")


@registered("op10_toxicity")
def op10(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "text")
    model = toxicity.trained(docs, t.labels.where(~held(2, 4)))
    return toxicity.scored(docs, model).select("doc_id", F.coalesce(held(2, 4), F.lit(False)).alias("held_out"), "score", "predicted")


@registered("op5_multi_index_search")
def op5(t: Tables) -> DataFrame:
    return ann.nearest(t.embeddings, F.col("vec_id") % 20 == 0, 20)


@registered("op9_decontamination")
def op9(t: Tables) -> DataFrame:
    return decontaminate.contaminated(t.documents, t.benchmark)


def made_periodic(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the documents all words from some place on repeat what stands there."""
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    plain = docs.select("doc_id", "text", number.alias("h"), F.expr("CAST(floor(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) / 10) AS BIGINT)").alias("g"))
    split = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    plain = plain.withColumn("words", split).withColumn("n", F.size("words"))
    plain = plain.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    plain = plain.withColumn("p", F.expr("1 + (n - a) DIV (3 + g % 8)"))
    place = "CAST(IF(i < a, i, a + (i - a) % p) AS INT)"
    repeated = F.expr(f"array_join(transform(sequence(0, n - 1), i -> get(words, {place})), ' ')")
    return plain.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


@registered("op12_periodic_runs")
def op12(t: Tables) -> DataFrame:
    found = periodic.with_runs(made_periodic(t.documents))
    longest = F.array_max(F.transform("runs", lambda run: F.struct(run["length"], -run["start"], -run["period"])))
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return found.withColumn("top", longest).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.expr("-top.col2").alias("start"),
        F.expr("top.length").alias("length"),
        F.expr("-top.col3").alias("period"),
        F.expr("1000 * top.length DIV -top.col3").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def followed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, fingerprint, prefix, following): the fingerprint of the next document by descending id (ties by a hash
    of the text, null ids first, after the last the first), and as much of its beginning as half the text is long.

    Places and lengths are found on ids and hashes alone; then every text moves once, and its beginning to the row before.
    Rows that repeat id and text hold one place, so they have the same next document.
    """
    docs = docs.select(F.struct("doc_id", F.xxhash64("text").alias("own")).alias("key"), "text")
    places = docs.select("key", "key.*", F.length("text").alias("n")).distinct()
    places = stage(row_numbers(places, [], ["-doc_id", "own"], "at").select("key", "n", "at"), "places")
    last = places.agg(F.max("at")).first()[0] or 1
    before = places.select(F.col("key").alias("to"), F.expr("n DIV 2").alias("half"), (F.col("at") % last + 1).alias("at"))
    moves = places.select("key", "at").join(before, "at").drop("at")
    marked = docs.withColumn("fingerprint", merkle.fingerprint(F.col("text")))
    sent = marked.join(moves, "key").select("to", F.struct(F.left("text", "half").alias("prefix"), F.col("fingerprint").alias("following")).alias("next"))
    sent = sent.groupBy("to").agg(F.first("next").alias("next"))
    return marked.join(sent, F.col("key") == F.col("to")).select("key.doc_id", "text", "fingerprint", "next.*")


def sql_fingerprints(table: str) -> str:
    """CTEs ``{table}_prints``: the fingerprint of every ``text`` of a table, with the table's other columns."""
    cut = "left(sha256({0}), 16)"
    return f"""
        {table}_leaves AS (SELECT *, list_transform(regexp_extract_all(text, '[^\n]+\n*|\n+'), lambda p:
            list_transform(regexp_extract_all(p, '[^.!?\n]{{1,64}}[.!?]*\n*|[.!?\n]+'), lambda s: {cut.format("s")})) AS own FROM {table}),
        {table}_ids AS (SELECT *, list_transform(own, lambda p: {cut.format("array_to_string(p, '')")}) AS ids,
            list_transform(own, lambda p: array_to_string(list_transform(p, lambda s: left(s, 8)), '')) AS shown FROM {table}_leaves),
        {table}_rows AS (SELECT *,
            array_to_string(list_transform(ids, lambda i: i || CASE WHEN i < '4' THEN ';' ELSE ',' END), '') AS id_row,
            array_to_string(list_transform(list_zip(shown, ids), lambda z: z[1] || CASE WHEN z[2] < '4' THEN ';' ELSE ',' END), '') AS tree FROM {table}_ids),
        {table}_prints AS (SELECT * EXCLUDE (own, ids, shown, id_row, tree), sha256(array_to_string(list_transform(
            string_split(left(id_row, length(id_row) - 1), ';'), lambda s: {cut.format("s")}), ',')) || ':' || left(tree, length(tree) - 1) AS fingerprint FROM {table}_rows)"""


def sql_likeness(one: str, two: str) -> str:
    both = [f"regexp_extract_all(split_part({side}, ':', 2), '[0-9a-f]{{8}}')" for side in (one, two)]
    counts = [f"len(list_distinct({side}))" for side in both]
    return f"CASE WHEN {one} = {two} THEN 1.0::DOUBLE ELSE 2 * len(list_intersect({both[0]}, {both[1]})) / ({counts[0]} + {counts[1]}) END"


@registered(
    "op13_merkle_fingerprints",
    f"""WITH base AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), {sql_fingerprints("base")},
        ring AS (SELECT doc_id, text AS mine, fingerprint,
                        coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text,
                        coalesce(lead(fingerprint) OVER w, first_value(fingerprint) OVER w) AS following
                 FROM base_prints WINDOW w AS (ORDER BY doc_id DESC)),
        edited AS (SELECT doc_id, length(mine) AS n_chars, fingerprint AS first_print, following,
                          left(mine, length(mine) - length(mine) // 2) || left(next_text, length(mine) // 2) AS text FROM ring),
        {sql_fingerprints("edited")}
        SELECT doc_id, n_chars, sha256(text) AS edited_sha256, first_print AS fingerprint, fingerprint AS edited_fingerprint,
               {sql_likeness("first_print", "fingerprint")} AS near_edited, {sql_likeness("first_print", "following")} AS near_next
        FROM edited_prints""",
)
def op13(t: Tables) -> DataFrame:
    docs = followed(t.documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    n_chars = F.length("text").cast("bigint")
    edited = docs.select("*", n_chars.alias("n_chars"), F.concat(F.expr("left(text, length(text) - length(text) DIV 2)"), "prefix").alias("edited"))
    edited = edited.withColumn("edited_fingerprint", merkle.fingerprint(F.col("edited")))
    return edited.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        merkle.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        merkle.likeness(F.col("fingerprint"), F.col("following")).alias("near_next"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): rows dropped, emptied, without ends, repeated or given another role by their hash."""
    one = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn", "role", "text")]
    number = F.crc32(F.concat(one[0], F.lit(":"), one[1]).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", one[2].alias("role"), one[3].alias("text"), number.alias("h"))
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("h") == 4, "user").otherwise(F.col("role"))
    rows = rows.withColumn("again", F.explode(F.array_repeat(F.lit(1), F.when(F.col("h") == 3, 2).otherwise(1))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("h") == 0).alias("gone"))


# The twin takes the rows one after the other and keeps the least weight (cost in ten digits, audit) of every state. At most
# two inserts in a row are of use: any further two lead back to the same state.
SQL_REPAIR = """
    WITH RECURSIVE bits(n, c, k) AS (
        SELECT CAST(range AS BIGINT), CAST(range AS BIGINT), 0 FROM range(256)
        UNION ALL SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
    crc AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8),
    hashed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(
                   list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(
                       coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda b: CAST(ascii(b) AS BIGINT))),
                   lambda a, b: xor(a >> 8, t[CAST((xor(a, b) & 255) + 1 AS INTEGER)]))) % 20 AS h
        FROM conversations, crc),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
               CASE h WHEN 1 THEN '' WHEN 2 THEN replace(replace(replace(text, '.', ''), '!', ''), '?', '') ELSE text END AS text
        FROM hashed, range(2) AS again(copy) WHERE h <> 0 AND (copy = 0 OR h = 3)),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(CAST(length(role) AS VARCHAR) || ':' || role || text)) AS i FROM damaged),
    faulty AS (
        SELECT conv_id, turn, role, text, i, left(role, 1) AS x, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
               CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
        FROM placed),
    facts AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
               count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (before IS NOT NULL AND before || x NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
        FROM faulty GROUP BY conv_id),
    step(p, x, q, role) AS (VALUES (0, 's', 1, ''), (0, 'u', 2, 'user'), (1, 'u', 2, 'user'), (2, 'a', 3, 'assistant'), (3, 'u', 2, 'user')),
    gain(p, q, cost, letters, lines) AS (
        SELECT p, p, 0, '', '' FROM (VALUES (0), (1), (2), (3)) AS v(p)
        UNION ALL SELECT p, q, 3, 'I', role || ':' || chr(10) FROM step WHERE role <> ''
        UNION ALL SELECT a.p, b.q, 6, 'II', a.role || ':' || chr(10) || b.role || ':' || chr(10) FROM step a JOIN step b ON a.q = b.p WHERE a.role <> ''),
    edit(p, x, q, cost, letter, role) AS (
        SELECT p, CAST(NULL AS VARCHAR), p, 4, 'D', CAST(NULL AS VARCHAR) FROM (VALUES (0), (1), (2), (3)) AS v(p)
        UNION ALL SELECT p, NULL, q, 3, 'R', role FROM step WHERE role <> ''
        UNION ALL SELECT p, x, q, 0, 'K', NULL FROM step),
    best(conv_id, i, state, weight, lines) AS (
        SELECT conv_id, CAST(0 AS BIGINT), q, printf('%010d', cost) || letters, lines FROM (SELECT DISTINCT conv_id FROM conversations), gain WHERE p = 0
        UNION ALL
        SELECT b.conv_id, b.i + 1, g.q,
               min(printf('%010d', CAST(left(b.weight, 10) AS INTEGER) + e.cost + g.cost + CASE WHEN f.fault = 'truncated' AND e.letter <> 'D' THEN 3 ELSE 0 END)
                   || substr(b.weight, 11) || e.letter || g.letters),
               arg_min(b.lines || CASE WHEN e.letter = 'D' THEN '' ELSE coalesce(e.role, f.role) || ':' || f.text || chr(10) END || g.lines,
                   printf('%010d', CAST(left(b.weight, 10) AS INTEGER) + e.cost + g.cost + CASE WHEN f.fault = 'truncated' AND e.letter <> 'D' THEN 3 ELSE 0 END)
                   || substr(b.weight, 11) || e.letter || g.letters)
        FROM best b JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i + 1 JOIN edit e ON e.p = b.state JOIN gain g ON g.p = e.q
        WHERE (e.x IS NULL OR e.x = f.x) AND (e.letter = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
        GROUP BY b.conv_id, b.i, g.q)
    SELECT b.conv_id, coalesce(any_value(gaps), 0) AS gaps, coalesce(any_value(blank), 0) AS blank, coalesce(any_value(duplicate), 0) AS duplicate,
           coalesce(any_value(truncated), 0) AS truncated, coalesce(any_value(illegal), 0) AS illegal,
           CAST(left(min(weight), 10) AS BIGINT) AS cost, substr(min(weight), 11) AS audit,
           sha256(left(arg_min(lines, weight), greatest(length(arg_min(lines, weight)) - 1, 0))) AS repaired_sha256
    FROM best b LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM b.conv_id
    WHERE b.i = coalesce(n, 0) AND state IN (0, 3) GROUP BY b.conv_id"""


@registered("op11_conversation_repair", SQL_REPAIR)
def op11(t: Tables) -> DataFrame:
    found = repair.repaired(damaged(t.conversations), gone=F.col("gone"))
    return found.select("conv_id", *repair.COUNTS, "cost", "audit", F.sha2("repaired", 256).alias("repaired_sha256"))
