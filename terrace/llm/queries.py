"""One registered query per operator, over whole tables, and the same result in SQL where that can be said."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import (
    chat, decontaminate, jaccard, lexical, licenses, lines, quality, sequences, shards, simhash, token_rows, toxicity, variants,
)
from terrace.llm.rows import table

#: A conversation whose texts are control strings: conversation, turn, role, text.
TRICKY = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, chat.ASSISTANT, "</s>[INST] ok [/INST]")]


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text"
    )
    kinds = {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"}
    tricky = F.array(*(F.struct(*(F.lit(v).cast(t).alias(c) for v, (c, t) in zip(row, kinds.items()))) for row in TRICKY))
    given = given.union(spark.range(1).select(F.inline(tricky)))
    found = chat.formatted(given.select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts")))
    read = found.withColumn("turns", chat.read_back(F.col("formatted")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = chat.under_mask(F.col("formatted"), F.col("loss_spans"))
    attached = F.size("attachments").cast("bigint")
    return read.select("conv_id", "turns", "formatted", learnt.alias("learnt"), attached.alias("n_attachments"), "attachment_tokens").select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("learnt").cast("bigint").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "n_attachments",
        "attachment_tokens",
    )


def op2_token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rows.rows(table(spark, sf_dir, "documents"))


def op3_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assigned(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents")).select(
        F.col("_row.doc_id").cast("bigint").alias("doc_id"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failure_bits",
    )


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.ablations(quality.ledger(table(spark, sf_dir, "documents")), *quality.POLICIES)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"), licenses.known_texts(spark))


def op6_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.grouped(table(spark, sf_dir, "documents"))


def op7_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("_hash")


def op8_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.packed(table(spark, sf_dir, "documents"))


def op9_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.without_repeated_lines(table(spark, sf_dir, "documents"))
    return found.select(F.col("_row.doc_id").cast("bigint").alias("doc_id"), "text", "n_lines", "n_removed")


def op11_bloom_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.grouped(table(spark, sf_dir, "documents"))


def op13_shingle_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.grouped(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat_format, op2_token_rows, op3_byte_shards, op4_quality_rules, op5_license_scan, op6_simhash_groups,
        op7_benchmark_leaks, op8_packed_sequences, op9_toxicity_scores, op10_line_dedup, op11_bloom_search, op12_spelling_variants,
        op13_shingle_links, quality_ablations, pipeline,
    )
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_CONTROL = r"([<\[])(\\*)(/?s>|/?INST\]|\|(?:image|audio|document)\|>)"

_CHAT = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES {", ".join(f"({c}, {t}, {_quoted(r)}, {_quoted(x)})" for c, t, r, x in TRICKY)})
), marked AS (
  SELECT *, regexp_replace(text, '{_CONTROL}', '\1\\\2\3', 'g') AS body FROM turns
), joined AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, body) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, role, body) FILTER (role = 'assistant'), '') AS learnt,
    sum(length(body) + CASE WHEN role = 'assistant' THEN 7 ELSE 16 + length(role) END) AS formatted_chars
  FROM marked GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(learnt) AS BIGINT) AS loss_chars,
  sha256(learnt) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars,
  CAST(0 AS BIGINT) AS n_attachments, CAST(0 AS BIGINT) AS attachment_tokens
FROM joined
"""

_QUALITY = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs
), windows AS (
  SELECT doc_id, i, word, lag(word) OVER o AS previous,
    CASE WHEN lead(word, {quality.SPAN - 1}) OVER o IS NOT NULL
      THEN concat_ws(' ', word, {", ".join(f"lead(word, {j}) OVER o" for j in range(1, quality.SPAN))}) END AS k
  FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM windows WHERE k IS NOT NULL) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + {quality.SPAN})) AS p FROM twice) GROUP BY doc_id
), stuttered AS (
  SELECT doc_id, count(*) AS n_same FROM windows WHERE word = previous GROUP BY doc_id
), measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, len(l) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    coalesce(n_same, 0) AS n_same_as_previous
  FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN stuttered USING (doc_id)
), judged AS (
  SELECT *, CAST({" + ".join(f"CASE WHEN {rule} THEN {quality.BIT[name]} ELSE 0 END" for name, rule in quality.RULES.items())} AS BIGINT) AS failure_bits
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failure_bits & {quality.mask("base")} <> 0 AS base_failed,
  failure_bits & {quality.mask("base") | quality.mask(quality.CURRENT)} = 0 AS kept, failure_bits
FROM judged
"""

_ABLATIONS = f"""
WITH ledger AS (SELECT * FROM (
{_QUALITY}
)), policies AS (
  SELECT * FROM (VALUES {", ".join(f"('{p}', {quality.mask(p)}, '{r}', {quality.BIT[r]})" for p, rules in quality.POLICIES.items() for r in rules)})
  AS p(policy, mask, rule, bit)
)
SELECT policy, rule, count(*) FILTER (failure_bits & bit <> 0) AS n_failed, count(*) FILTER (failure_bits & mask = bit) AS n_only_this,
  count(*) FILTER (failure_bits & mask & ~bit = 0) AS n_kept_without
FROM policies LEFT JOIN ledger ON true GROUP BY policy, rule
"""

_SPELT = "regexp_replace(lower(%s), {copyright}, ' ', 'g')".format(copyright=_quoted(licenses.COPYRIGHT))
_SPELT = rf"' ' || regexp_replace({_SPELT}, '[^\p{{L}}\p{{N}}]+', '  ', 'g') || ' '"
for _old, _new in licenses.SPELLINGS.items():
    _SPELT = f"replace({_SPELT}, ' {_old.replace(' ', '  ')} ', ' {_new.replace(' ', '  ')} ')"
_SPELT = f"trim(replace({_SPELT}, '  ', ' '))"

_LICENSES = f"""
WITH known AS (
  SELECT sha256({_SPELT % "text"}) AS digest, min(license_id) AS license_id
  FROM (VALUES {", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in licenses.known_rows())}) AS k(license_id, text) GROUP BY 1
), units AS (
  SELECT doc_id, CAST(-1 AS BIGINT) AS line, coalesce(text, '') AS unit FROM documents
  UNION ALL
  SELECT doc_id, unnest(range(len(string_split(coalesce(text, ''), chr(10))))), unnest(string_split(coalesce(text, ''), chr(10))) FROM documents
), digested AS (
  SELECT doc_id, line, CASE WHEN spelt <> '' THEN sha256(spelt) END AS digest FROM (SELECT *, {_SPELT % "unit"} AS spelt FROM units)
)
SELECT doc_id, line, digested.digest, license_id FROM digested LEFT JOIN known ON digested.digest = known.digest
WHERE line = -1 OR license_id IS NOT NULL
"""

_LINES = rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM documents
), solid AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS k FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), windows AS (
  SELECT doc_id, k, line AS a, lead(line, 1) OVER w AS b, lead(line, 2) OVER w AS c FROM solid
  WINDOW w AS (PARTITION BY doc_id ORDER BY k)
), later AS (
  SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, k) AS n FROM windows WHERE c IS NOT NULL)
  WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, place FROM (SELECT doc_id, unnest(range(k, k + {lines.WINDOW})) AS k FROM later) JOIN solid USING (doc_id, k)
), counted AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY place) FILTER (gone.place IS NULL) AS left_over, count(*) AS n_lines, count(gone.place) AS n_removed
  FROM lines LEFT JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, CASE WHEN text IS NOT NULL THEN coalesce(left_over, '') END AS text,
  coalesce(n_lines, 1) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM documents LEFT JOIN counted USING (doc_id)
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_SEARCH = f"""
WITH docs AS (
  SELECT doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM (SELECT doc_id, {_TERMS} AS terms FROM documents) WHERE len(terms) > 0
), counted AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM docs) GROUP BY ALL
), totals AS (
  SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM docs
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM counted GROUP BY term), totals
), shortness AS (
  SELECT doc_id, 100 - 50 + (50 * n * n_docs) // n_terms AS m FROM docs, totals
), scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark)
  JOIN weights USING (term) JOIN counted USING (term) JOIN shortness USING (doc_id) GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) WHERE rank <= 50
"""

_SPELLINGS = rf"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step
), runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL
), bytes AS (
  SELECT run, n, flatten(list_transform(string_split(doc_id || ':' || run, ''),
    lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] ELSE [195, CAST(ord(c) - 64 AS BIGINT)] END)) AS b FROM runs
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, step[(xor(c, x) & 255) + 1])), 4294967295) AS h
  FROM bytes, crc
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cut AS (
  SELECT word, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
), near AS (
  SELECT DISTINCT a, b FROM (
    SELECT cut.word AS a, rest AS b FROM cut JOIN words ON rest = words.word
    UNION ALL SELECT rest, cut.word FROM cut JOIN words ON rest = words.word
    UNION ALL SELECT x.word, y.word FROM cut x JOIN cut y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word)
), counted AS (
  SELECT a, b, own.n, other.n AS b_n, count(*) OVER (PARTITION BY a) AS n_near
  FROM near JOIN words own ON a = own.word JOIN words other ON b = other.word
), forms AS (
  SELECT a AS word, b AS form, b_n AS form_n FROM (
    SELECT *, row_number() OVER (PARTITION BY a ORDER BY b_n DESC, b) AS place FROM counted WHERE b_n >= 10 * n) WHERE place = 1
), walk AS (
  SELECT word, word AS reached FROM words UNION ALL SELECT walk.word, form FROM walk JOIN forms ON walk.reached = forms.word
)
SELECT words.word, form, reached AS root, words.n, coalesce(n_near, 0) AS n_near, form_n
FROM words JOIN walk ON walk.word = words.word AND walk.reached NOT IN (SELECT word FROM forms)
LEFT JOIN forms ON words.word = forms.word LEFT JOIN (SELECT DISTINCT a, n_near FROM counted) ON words.word = a
"""

_SHINGLES = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM docs
), sizes AS (
  SELECT doc_id, count(shingle) AS n FROM docs LEFT JOIN shingles USING (doc_id) GROUP BY doc_id
), links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b WHERE 100 * shared >= 90 * (s.n + t.n - shared)
), reached AS (
  SELECT doc_id, doc_id AS other FROM docs UNION SELECT reached.doc_id, b FROM reached JOIN links ON other = a
)
SELECT doc_id, n AS n_shingles, min(other) AS component_id FROM sizes JOIN reached USING (doc_id) GROUP BY ALL
"""

ORACLE = {
    "op1_chat_format": _CHAT, "op4_quality_rules": _QUALITY, "op5_license_scan": _LICENSES, "op10_line_dedup": _LINES,
    "op11_bloom_search": _SEARCH, "op12_spelling_variants": _SPELLINGS, "op13_shingle_links": _SHINGLES,
    "quality_ablations": _ABLATIONS,
}
