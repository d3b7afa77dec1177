"""The queries of this subpackage: each operator on its whole table with production parameters, and SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat_format, conversation_repair, decontaminate, divergence, language, mixing, near_dedup, periodic_runs, quality_classifier, sharding,
    suffix_dedup, token_output, toxicity,
)
from tidemark.llm.common import fold, table
from tidemark.session import materialise, scratch_path

SHARDS = [f"shard-{i:03d}" for i in range(128)]
# Domains of the labelled table, and the shares of tokens wanted from them.
DOMAINS = ["plain", "toxic", "junk"]
SHARES = {"plain": 0.90, "toxic": 0.05, "junk": 0.05}
CATEGORIES = ["low_quality", "toxic"]


def domain():
    return F.when(F.col("toxic") == 1, 1).when(F.col("quality") == 0, 2).when(F.col("quality") == 1, 0)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    domains = mixing.fit_domains(docs, table(spark, sf, "labels"), domain(), DOMAINS)
    rated = mixing.rates(docs, domains, SHARES)
    return rated.withColumn("copies", mixing.copies(F.col("rate"), F.col("doc_id"), slack=0.0))


def op2_token_output(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    token_output.write_tokens(table(spark, sf, "documents"), path, vocabulary())
    return token_output.digests(spark, path)


def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    chain = toxicity.fit(docs, labels, CATEGORIES, fold(F.col("doc_id"), 3) != 1)
    held_out = (fold(F.col("doc_id"), 3) == 1).alias("held_out")
    return toxicity.predict(docs, chain).select("doc_id", held_out, F.col("p_toxic").alias("score"), (F.col("p_toxic") >= 0.5).cast("int").alias("predicted"), "p_low_quality")


def op4_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op5_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.judge(table(spark, sf, "documents"))


def op6_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    languages = language.fit(docs, fold(F.col("doc_id"), 4) != 2)
    held_out = (fold(F.col("doc_id"), 4) == 2).alias("held_out")
    return language.predict(docs, languages).select("doc_id", held_out, "lang_pred", "score")


def op7_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = quality_classifier.fit(docs, table(spark, sf, "labels"), fold(F.col("doc_id"), 3) != 1)
    held_out = (fold(F.col("doc_id"), 3) == 1).alias("held_out")
    return quality_classifier.scores(docs, model).select("doc_id", held_out, "score", "predicted")


def op8_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.groups(table(spark, sf, "documents"), words=4)


def op9_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.deduplicate(table(spark, sf, "documents"))


def op10_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.place(table(spark, sf, "documents"), SHARDS)


def op11_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    control = "'</s>[INST] ok [/INST]'"
    further = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', {control}), (-7L, 1L, 'assistant', {control}) AS t(conv_id, turn, role, text)")
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(further)
    return chat_format.read_back(materialise(chat_format.form(rows), "formatted"))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, cut short, repeated and given to the user, by a hash of id and turn."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind, text = F.crc32(key.cast("binary")) % 20, F.coalesce("text", space)
    return (
        rows.where(kind != 0)
        .withColumn("times", F.when(kind == 3, 2).otherwise(1))
        .select(
            "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
            F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
            F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("again"),
        )
        .drop("again")
    )


def op12_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations")
    return conversation_repair.report(damaged(rows), ids=rows)


def made_periodic(docs: DataFrame) -> DataFrame:
    """Every tenth document, by the hash of its id, repeats a stretch of its words from some word to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    docs = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).alias("g")).withColumn("n", F.size("w"))
    docs = docs.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    docs = docs.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    part = F.slice("w", F.col("a") + 1, F.col("p"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    again = F.slice(F.flatten(F.array_repeat(part, times)), F.lit(1), F.col("n") - F.col("a"))
    made = F.concat_ws(" ", F.concat(F.slice("w", F.lit(1), F.col("a")), again))
    return docs.select("doc_id", F.when(F.col("a").isNotNull(), made).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = periodic_runs.find(made_periodic(table(spark, sf, "documents"))).withColumn("most", periodic_runs.longest())
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("most.start").alias("start"), F.col("most.length").alias("length"),
        F.col("most.period").alias("period"), F.floor(1000 * F.col("most.length") / F.col("most.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mixing, op2_token_output, op3_toxicity, op4_decontaminate, op5_divergence, op6_language, op7_quality, op8_near_dedup,
        op9_suffix_dedup, op10_sharding, op11_chat_format, op12_conversation_repair, op13_periodic_runs,
    )
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS4 = f"regexp_extract_all({_LOWER.format('coalesce(text, chr(32))')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_WORDS8 = f"regexp_extract_all({_LOWER.format('coalesce(text, chr(32))')}, '[^\\x20\\x09-\\x0D]+')"

# Characters that the template of op11 adds around a text, and the longer of a text and its escaped form.
_ESCAPED = "length(regexp_replace({}, '([<\\[])(\\\\*)(s>|/s>|INST\\]|/INST\\]|ASSISTANT\\]|ROLE\\]|TEXT\\]|/ROLE\\])', '\\1\\\\\\2\\3', 'g'))"

# crc32 of short ASCII texts, bit by bit: every character enters at the first of its eight steps.
_CRC32 = (
    "xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split({}, ''), "
    "lambda z: [CAST(ascii(z) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))), lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))))"
)
_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _edits_sql(state: int) -> str:
    """The best edits of a row in a grammar state, without insertions: cost, letters and repaired rows of all that follows."""
    follows = (2, 2, 3, 2)[state]
    kept = {0: "WHEN c = 's' THEN s1 WHEN c = 'u' THEN s2", 1: "WHEN c = 'u' THEN s2", 2: "WHEN c = 'a' THEN s3", 3: "WHEN c = 'u' THEN s2"}[state]
    role = "assistant" if state == 2 else "user"
    return (
        f"list_sort(list_filter([{{'c': s{state}.c + 4, 'a': 'D' || s{state}.a, 't': s{state}.t}}, "
        f"CASE WHEN fault < 2 AND (CASE {kept} END) IS NOT NULL THEN {{'c': (CASE {kept} END).c + 3 * fault, 'a': 'K' || (CASE {kept} END).a, 't': chr(10) || role || ':' || text || (CASE {kept} END).t}} END, "
        f"CASE WHEN fault < 2 THEN {{'c': s{follows}.c + 3 + 3 * fault, 'a': 'R' || s{follows}.a, 't': chr(10) || '{role}:' || text || s{follows}.t}} END], lambda z: z IS NOT NULL))[1]"
    )


def _inserted_sql(edits: str, after: str, role: str) -> str:
    return f"list_sort([{edits}, {{'c': {after}.c + 3, 'a': 'I' || {after}.a, 't': chr(10) || '{role}:' || {after}.t}}])[1]"


SQL: dict[str, str] = {
    "op11_chat_format": (
        "WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations "
        "UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]') "
        "SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256, "
        "CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars, "
        "sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, "
        f"CAST(3 + sum({_ESCAPED.format('text')} + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 17 ELSE 23 + {_ESCAPED.format('role')} END) AS BIGINT) AS formatted_chars "
        "FROM c GROUP BY conv_id"
    ),
    "op12_conversation_repair": (
        "WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, "
        f"{_CRC32.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS d FROM conversations), "
        "r AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, "
        "unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS again FROM k WHERE d <> 0), "
        f"s AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS copy, right(rtrim(text, {_BLANKS}), 1) AS e FROM r), "
        "f AS (SELECT conv_id, turn, role, text, left(role, 1) AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, "
        "CASE WHEN e = '' THEN 2 WHEN copy > 1 THEN 3 WHEN e NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS fault FROM s), "
        "w(conv_id, i, s0, s1, s2, s3) AS (SELECT conv_id, count(*) + 1, {'c': 0, 'a': '', 't': ''}, {'c': 6, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}, "
        "{'c': 3, 'a': 'I', 't': chr(10) || 'assistant:'}, {'c': 0, 'a': '', 't': ''} FROM f GROUP BY conv_id UNION ALL "
        f"SELECT conv_id, i, {_inserted_sql('b0', 'f2', 'user')}, {_inserted_sql('b1', 'f2', 'user')}, f2, f3 FROM ("
        f"SELECT conv_id, i, b0, b1, {_inserted_sql('b2', 'b3', 'assistant')} AS f2, {_inserted_sql('b3', 'b2', 'user')} AS f3 FROM ("
        f"SELECT f.conv_id, f.i, {_edits_sql(0)} AS b0, {_edits_sql(1)} AS b1, {_edits_sql(2)} AS b2, {_edits_sql(3)} AS b3 FROM w JOIN f ON f.conv_id = w.conv_id AND f.i = w.i - 1))), "
        "m AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 2) AS blank, count(*) FILTER (fault = 3) AS duplicate, "
        "count(*) FILTER (fault = 1) AS truncated, count(*) FILTER (c || nxt NOT IN ('su', 'ua', 'au')) AS illegal "
        "FROM (SELECT *, lead(c) OVER (PARTITION BY conv_id ORDER BY i) AS nxt FROM f) GROUP BY conv_id) "
        "SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, "
        "CAST(coalesce(w.s0.c, 0) AS BIGINT) AS cost, coalesce(w.s0.a, '') AS audit, sha256(coalesce(substr(w.s0.t, 2), '')) AS repaired_sha256 "
        "FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN m ON m.conv_id = o.conv_id LEFT JOIN w ON w.conv_id = o.conv_id AND w.i = 1"
    ),
    "op4_decontaminate": (
        f"WITH d AS (SELECT doc_id, {_WORDS4} AS w FROM documents), "
        f"b AS (SELECT item_id, {_WORDS4} AS w FROM benchmark WHERE item_id IS NOT NULL), "
        "bw AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(10, len(w)) AS n, list_slice(w, i, i + least(10, len(w)) - 1) AS win "
        "FROM b, unnest(range(1, greatest(2, len(w) - 8))) AS r(i) WHERE len(w) > 0), "
        "sizes AS (SELECT DISTINCT n FROM bw), "
        "dw AS (SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)), "
        "hits AS (SELECT doc_id, dw.n, i, item FROM dw JOIN bw USING (win)), "
        "covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id), "
        "items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id) "
        "SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, "
        "sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated "
        "FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"
    ),
    "op8_near_dedup": (
        f"WITH RECURSIVE d AS (SELECT doc_id, {_WORDS8} AS w FROM documents), "
        "s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN w ELSE list_slice(w, i, i + 3) END AS g FROM d, unnest(range(1, greatest(2, len(w) - 2))) AS r(i) WHERE len(w) > 0), "
        "n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), "
        "h AS (SELECT doc_id, g FROM s), "
        "both_ AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM h a JOIN h b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL), "
        "links AS (SELECT x, y FROM both_ JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 80 * (nx.n + ny.n - k)), "
        "e AS (SELECT x, y FROM links UNION SELECT y, x FROM links), "
        "reach(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT a, y FROM reach JOIN e ON b = x), "
        "c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) "
        "SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id, coalesce(c.component_id, d.doc_id) = d.doc_id AS kept "
        "FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)"
    ),
}
