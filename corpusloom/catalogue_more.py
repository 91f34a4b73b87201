"""Further queries by name and their SQL, registered beside the catalogue's: scans and sinks, single functions, joins that find
rows, reviews that disagree, and selections with floors. Imported by corpusloom.catalogue."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.catalogue import _PAIRS, SQL, documents, joined, pairs, query, sql_any, sql_clean, sql_content, sql_fp, sql_reasons, sql_repeated, sql_tokens, table
from corpusloom.functions import fixed
from corpusloom.functions import scores as S
from corpusloom.functions import text as T
from corpusloom.operators import audit, consensus, dedup, gates, generation, provenance, selection
from corpusloom.sources import files, sinks
from corpusloom.sources.tables import checkpointed, shared_folder

# --- scans and sinks ---------------------------------------------------------------------------------------------------

ROW = "doc_id long, text string, source string"


def _fresh(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _with_bad_lines(spark, sf_dir: str) -> str:
    """Documents as JSON lines, with a line that is none after every third one."""
    path = _fresh(spark, "lines")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.to_json(F.struct("doc_id", "text", "source"), {"ignoreNullFields": "false"}).alias("line"))
    lines = F.when(F.col("doc_id") % 3 == 0, F.array("line", F.lit('{"doc_id": '), F.lit("[1]"))).otherwise(F.array("line"))
    rows.select(F.explode(lines).alias("value")).write.text(path)
    return path


@query("SELECT doc_id, text, source FROM documents")
def scan_strict(spark, sf_dir):
    path = _fresh(spark, "rows")
    sinks.write_rows(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), path)
    return files.read_strict(spark, path, ROW).select("doc_id", "text", "source")


@query("SELECT doc_id, text, source FROM documents")
def scan_lenient(spark, sf_dir):
    return files.read_lenient(spark, _with_bad_lines(spark, sf_dir), ROW).select("doc_id", "text", "source")


@query("""SELECT doc_id, NULL::VARCHAR AS error FROM documents UNION ALL SELECT NULL, 'invalid_json' FROM documents WHERE doc_id % 3 = 0
UNION ALL SELECT NULL, 'invalid_json' FROM documents WHERE doc_id % 3 = 0""")
def scan_audited(spark, sf_dir):
    return files.read_audited(spark, _with_bad_lines(spark, sf_dir), ROW).select("doc_id", "error")


@query("SELECT doc_id, text FROM documents WHERE length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) >= 160")
def scan_inputs(spark, sf_dir):
    return files.read_inputs(spark, _with_bad_lines(spark, sf_dir), ROW).select("doc_id", "text")


@query(f"SELECT {sql_clean('text')} AS paragraph FROM documents WHERE {sql_clean('text')} <> ''")
def paragraph_files(spark, sf_dir):
    """Cleaned texts through the paragraph sink, and back by a scan of whole files."""
    path = _fresh(spark, "paragraphs")
    rows = documents(spark, sf_dir).select(T.clean_text(F.col("text")).alias("text")).where("text <> ''")
    sinks.write_paragraphs(rows, path)
    texts = files.read_texts(spark, f"{path}/*.txt").select(F.explode(F.split("value", "\n\n")).alias("paragraph"))
    return texts.where("paragraph <> ''")


@query("SELECT lang, source, count(*)::BIGINT AS n FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL GROUP BY lang, source")
def scan_metadata(spark, sf_dir):
    """One JSON document for each language and source, read by their pattern."""
    path = _fresh(spark, "metadata")
    counts = table(spark, sf_dir, "documents").where("lang is not null and source is not null").groupBy("lang", "source").agg(F.count("*").alias("n"))
    sinks.write_rows(counts.repartition("lang", "source"), path, by=["lang", "source"])
    found = files.read_documents(spark, f"{path}/lang=*/source=*/*.json", "n bigint")
    return found.select(F.regexp_extract("path", "lang=([^/]*)", 1).alias("lang"), F.regexp_extract("path", "source=([^/]*)", 1).alias("source"), "n")


@query("SELECT (SELECT count(*) FROM documents)::BIGINT AS there, 0::BIGINT AS absent, 0::BIGINT AS optional_rows, (SELECT count(*) FROM documents)::BIGINT AS lines")
def row_counts(spark, sf_dir):
    missing, path = f"{sf_dir}/no_such_table.parquet", _fresh(spark, "rows")
    sinks.write_rows(table(spark, sf_dir, "documents").select("doc_id"), path)
    found = [files.row_count(spark, f"{sf_dir}/documents.parquet"), files.row_count(spark, missing), files.optional(spark, missing, "x int").count(), files.line_count(spark, path)]
    return spark.createDataFrame([tuple(found)], "there bigint, absent bigint, optional_rows bigint, lines bigint")


# --- text --------------------------------------------------------------------------------------------------------------


@query(f"""SELECT doc_id, array_to_string(list_filter([CASE WHEN contains(coalesce(text, ''), chr(65279)) THEN 'bom_removed' END,
CASE WHEN {sql_clean('text')} <> replace(coalesce(text, ''), chr(65279), '') THEN 'whitespace_normalized' END], lambda x: x IS NOT NULL), ',') AS operations FROM documents""")
def cleaning_operations(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").withColumn("composed", T.nfkc(F.col("text")))
    return rows.select("doc_id", joined(T.cleaning_operations(F.col("text"), F.col("composed"))).alias("operations"))


def sql_common(a: str, b: str) -> str:
    """Leading tokens that two lists share."""
    size = f"least(len({a}), len({b}))"
    return f"coalesce(nullif(list_position(list_transform(list_zip({a}[1:{size}], {b}[1:{size}]), lambda z: z[1] = z[2]), false), 0) - 1, {size})"


_HALVES = f"""WITH a AS (SELECT doc_id, {sql_tokens("text")} AS w, {sql_tokens("replace(substr(text, 1, length(text) // 2), 'e ', 'e, or ')")} AS h FROM documents)"""


@query(f"""{_HALVES} SELECT doc_id, CASE WHEN least(len(w), len(h)) > 0 THEN round({sql_common("w", "h")} / least(len(w), len(h))::DOUBLE, 6) ELSE 0 END AS shared,
CASE WHEN least(len(w), len(h)) > 0 THEN round({sql_common("w", "h")} / len(w)::DOUBLE, 6) ELSE 0 END AS covered, array_to_string(w[1:12], ' ') AS signature FROM a""")
def prefix_ratios(spark, sf_dir):
    """Each text against a changed half of itself."""
    rows = documents(spark, sf_dir)
    half = F.replace(F.expr("substring(text, 1, length(text) div 2)"), F.lit("e "), F.lit("e, or "))
    rows = rows.select("doc_id", T.tokens(F.col("text")).alias("w"), T.tokens(half).alias("h"))
    shared, covered = T.common_prefix_ratio(F.col("w"), F.col("h")), T.left_coverage_ratio(F.col("w"), F.col("h"))
    return rows.select("doc_id", F.round(shared, 6).alias("shared"), F.round(covered, 6).alias("covered"), T.prefix_signature(F.col("w")).alias("signature"))


_TOKEN = "(?i)[a-z0-9]+(?:[''’][a-z0-9]+)?"


def sql_span(quote: str, source: str, alias: str) -> str:
    """CTE columns start_at and end_at of the quote's words in the source; alias: a relation with id, quote and source."""
    keys = lambda c: f"list_transform(regexp_extract_all({c}, '{_TOKEN}'), lambda x: lower(replace(x, '’', '''')))"
    return f"""
{alias}_k AS (SELECT *, regexp_extract_all({source}, '{_TOKEN}') AS own, string_split_regex({source}, '{_TOKEN}') AS gaps, ' ' || array_to_string({keys(source)}, ' ') || ' ' AS hay,
  {keys(quote)} AS q FROM {alias}),
{alias}_p AS (SELECT *, CASE WHEN len(q) > 0 THEN strpos(hay, ' ' || array_to_string(q, ' ') || ' ') ELSE 0 END AS pos FROM {alias}_k),
{alias}_i AS (SELECT *, CASE WHEN pos > 0 THEN length(substr(hay, 1, pos)) - length(replace(substr(hay, 1, pos), ' ', '')) END AS i FROM {alias}_p),
{alias}_s AS (SELECT *, (list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(own[1:i - 1], lambda x: length(x))), 0))::INTEGER AS start_at,
  (list_sum(list_transform(gaps[1:i + len(q) - 1], lambda x: length(x))) + list_sum(list_transform(own[1:i + len(q) - 1], lambda x: length(x))))::INTEGER AS end_at FROM {alias}_i)"""


@query(f"""WITH q AS (SELECT doc_id, text AS source, lower(replace(substr(text, length(text) // 3, 60), ' ', ' - ')) AS quote FROM documents WHERE text IS NOT NULL),
{sql_span("quote", "source", "q")} SELECT doc_id, start_at, end_at FROM q_s""")
def evidence_spans(spark, sf_dir):
    """Where 60 characters from a third of a text on, in small letters and with other punctuation, stand in it by their words."""
    rows = table(spark, sf_dir, "documents").where("text is not null")
    quote = F.lower(F.replace(F.expr("substring(text, length(text) div 3, 60)"), F.lit(" "), F.lit(" - ")))
    rows = rows.select("doc_id", T.evidence_span(quote, F.col("text")).alias("span"))
    return rows.select("doc_id", F.col("span.start").alias("start_at"), F.col("span.end").alias("end_at"))


@query(_PAIRS + f""", r AS (SELECT conv_id, turn, 'Question: "' || question || '?"' AS raw FROM q),
b AS (SELECT *, regexp_replace(raw, '^["''“”]+|["''“”]+$', '', 'g') AS x FROM r), c AS (SELECT *, trim(regexp_replace(x, '(?i)^(?:{"|".join(fixed.QUESTION_LABELS)})', '')) AS y FROM b)
SELECT conv_id, turn, CASE WHEN length(y) >= 8 AND contains(y, '?') THEN y END AS question FROM c""")
def question_clean_up(spark, sf_dir):
    rows = pairs(spark, sf_dir)
    return rows.select("conv_id", "turn", T.question_cleaned(F.concat(F.lit('Question: "'), "question", F.lit('?"'))).alias("question"))


@query("SELECT doc_id, " + " + ".join(f"(length(text) - length(replace(text, '{m}', ''))) // {len(m)}" for m in gates.MOJIBAKE)
       + f" + len(regexp_extract_all(text, '[{''.join(gates.MOJIBAKE[1:])}][A-Za-z一-龥]'))::BIGINT AS score FROM documents WHERE text IS NOT NULL")
def mojibake_scores(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").where("text is not null")
    return rows.select("doc_id", generation.mojibake_score(F.col("text")).cast("bigint").alias("score"))


@query(_PAIRS + f""", c AS (SELECT conv_id, turn, answer, {sql_content("answer")} AS a, {sql_content("question")} AS s FROM q),
o AS (SELECT *, CASE WHEN len(a) > 0 THEN len(list_intersect(a, s)) / len(a)::DOUBLE ELSE 0 END AS o, round(1 - least(abs(length(answer) - 700) / 7000.0::DOUBLE, 0.2::DOUBLE), 4) AS e FROM c)
SELECT conv_id, turn, e AS evidence_quality, round(0.7::DOUBLE * o + 0.3::DOUBLE * e, 4) AS hard, round(0.55::DOUBLE * o + 0.25::DOUBLE * e + 0.2::DOUBLE * (1 - least(abs(length(answer) - 350) / 1800.0::DOUBLE, 0.2::DOUBLE)), 4) AS training FROM o""")
def quality_scores(spark, sf_dir):
    rows = pairs(spark, sf_dir).withColumn("o", T.overlap(T.content_tokens(F.col("answer")), T.content_tokens(F.col("question"))))
    rows = rows.withColumn("evidence_quality", S.paragraph_quality(F.col("answer")))
    hard, training = S.hard_quality(F.col("o"), F.col("evidence_quality")), S.training_quality(F.col("o"), F.col("evidence_quality"), F.length("answer"))
    return rows.select("conv_id", "turn", "evidence_quality", hard.alias("hard"), training.alias("training"))


@query(f"""WITH a AS (SELECT doc_id, {sql_clean("text")} AS t, {sql_tokens("text")} AS w FROM documents), rep AS {sql_repeated("a", "doc_id", "w")}
SELECT doc_id, CASE WHEN NOT (length(t) BETWEEN 240 AND 1800) THEN 'evidence_length' WHEN {sql_any("lower(t)", gates.BOILERPLATE)} THEN 'boilerplate' WHEN {sql_any("t", gates.MOJIBAKE)} THEN 'mojibake'
WHEN length(regexp_replace(t, '[^A-Za-z]', '', 'g')) / length(t)::DOUBLE < 0.6 THEN 'low_alphabetic_ratio' WHEN doc_id IN (SELECT doc_id FROM rep) THEN 'repetitive_evidence' END AS reason FROM a""")
def usable_evidence(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", T.clean_text(F.col("text")).alias("t"))
    return rows.select("doc_id", gates.evidence_reason(F.col("t")).alias("reason"))


@query(_PAIRS + """SELECT conv_id, turn, question, answer, 'passage' AS question_type, trim(substr(answer, 1, 40)) AS quote FROM q WHERE question <> '' AND answer <> ''""")
def tagged_payloads(spark, sf_dir):
    """Model texts with tags for odd conversations, else JSON with its type behind the closing brace, read back."""
    from corpusloom.plans import training

    rows = pairs(spark, sf_dir).where("question <> '' and answer <> ''").withColumn("quote", F.substring("answer", 1, 40))
    tag = lambda name, c: F.concat(F.lit(f"<{name}> "), c, F.lit(f"\n</{name}>"))
    tagged = F.concat(tag("question", "question"), tag("answer", "answer"), tag("evidence_quote", "quote"), tag("question_type", F.lit("passage")))
    body = F.to_json(F.struct("question", "answer", F.col("quote").alias("evidence_quote")))
    plain = F.concat(F.lit("```json\n"), body, F.lit(', "question_type": "passage"}\n```'))
    found = rows.withColumn("g", training.tagged_or_json(F.when(F.col("conv_id") % 2 == 1, tagged).otherwise(plain)))
    return found.select("conv_id", "turn", "g.question", "g.answer", "g.question_type", F.col("g.evidence_quote").alias("quote"))


@query(_PAIRS + """SELECT conv_id, turn, trim(question) AS instruction, trim(answer) AS output, 1 AS schema_version, length(trim(answer))::INTEGER AS char_count FROM q""")
def canonical_pairs(spark, sf_dir):
    return pairs(spark, sf_dir).select("conv_id", "turn", *gates.canonical_pair()).select("conv_id", "turn", "instruction", "output", "schema_version", "char_count")


# --- passages found again ----------------------------------------------------------------------------------------------

_KEYS = lambda c: f"array_to_string({c}, ' ')"
_ASKED = rf"""
WITH RECURSIVE l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
par AS (SELECT doc_id::VARCHAR AS source, pos AS idx, doc_id * 100000 + pos AS line, {sql_clean("raw")} AS evidence, {sql_tokens("raw")} AS w FROM l WHERE len({sql_tokens("raw")}) > 0),
t AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
u AS (SELECT 2 * doc_id AS id, ls[1] AS x FROM t UNION ALL SELECT 2 * doc_id + 1, ls[1] || ' ' || ls[2] || ' ' || coalesce(ls[3], '') FROM t WHERE len(ls) > 1),
ans AS (SELECT min(id) AS id, {sql_tokens("x")} AS a FROM u GROUP BY {sql_tokens("x")}),
single AS (SELECT {_KEYS("w")} AS k, min(source) AS source, min(idx) AS idx, min(evidence) AS evidence FROM par GROUP BY 1 HAVING count(*) = 1),
ex AS (SELECT id, s.source, s.idx, s.evidence FROM ans JOIN single s ON s.k = {_KEYS("a")}),
cand AS (SELECT id, a, source, idx, line, evidence, w, {sql_common("a", "w")} AS c FROM ans JOIN par ON {_KEYS("a[1:12]")} = {_KEYS("w[1:12]")} WHERE id NOT IN (SELECT id FROM ex)),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY coalesce(c / nullif(least(len(a), len(w)), 0)::DOUBLE, 0) DESC,
  floor(least(len(a), len(w)) / greatest(len(a), len(w))::DOUBLE * 10000) DESC, line) AS rn FROM cand) WHERE rn = 1),
g0 AS (SELECT id, a, source, idx, evidence AS e, w, 0 AS n FROM best),
g1 AS (SELECT g.id, g.a, g.source, g.idx, CASE WHEN p.w IS NULL THEN g.e ELSE g.e || ' ' || p.evidence END AS e, CASE WHEN p.w IS NULL THEN g.w ELSE g.w || p.w END AS w, CASE WHEN p.w IS NULL THEN 0 ELSE 1 END AS n
  FROM g0 g LEFT JOIN par p ON p.source = g.source AND p.idx = g.idx + 1),
g2 AS (SELECT g.id, g.a, g.source, g.idx, CASE WHEN p.w IS NULL THEN g.e ELSE g.e || ' ' || p.evidence END AS e, CASE WHEN p.w IS NULL THEN g.w ELSE g.w || p.w END AS w, CASE WHEN p.w IS NULL THEN g.n ELSE 2 END AS n
  FROM g1 g LEFT JOIN par p ON g.n = 1 AND {sql_common("g.a", "g.w")} < len(g.a) AND p.source = g.source AND p.idx = g.idx + 2),
g3 AS (SELECT g.id, g.a, g.source, g.idx, CASE WHEN p.w IS NULL THEN g.e ELSE g.e || ' ' || p.evidence END AS e, CASE WHEN p.w IS NULL THEN g.w ELSE g.w || p.w END AS w, CASE WHEN p.w IS NULL THEN g.n ELSE 3 END AS n
  FROM g2 g LEFT JOIN par p ON g.n = 2 AND {sql_common("g.a", "g.w")} < len(g.a) AND p.source = g.source AND p.idx = g.idx + 3)
"""


def _recovered(spark, sf_dir) -> DataFrame:
    """Provenance of each document's first line, and of its first three lines in one; equal texts once."""
    from corpusloom.catalogue import paragraph_lines

    lines = documents(spark, sf_dir).where("text is not null").select("doc_id", F.split("text", "\n", -1).alias("ls"))
    more = F.concat_ws(" ", F.get("ls", 0), F.get("ls", 1), F.coalesce(F.get("ls", 2), F.lit("")))
    asked = lines.select((2 * F.col("doc_id")).alias("id"), F.get("ls", 0).alias("x")).union(lines.where(F.size("ls") > 1).select(2 * F.col("doc_id") + 1, more))
    asked = asked.withColumn("k", T.fingerprint(F.col("x"))).groupBy("k").agg(F.min_by(F.struct("id", "x"), "id").alias("r")).select("r.*")
    return provenance.match(asked, paragraph_lines(spark, sf_dir), "id", "x")


@query(_ASKED + "SELECT id, source, idx::BIGINT AS paragraph_index, evidence FROM ex")
def provenance_of_lines(spark, sf_dir):
    return _recovered(spark, sf_dir).where("method = 'exact'").select("id", "source", "paragraph_index", "evidence")


@query(_ASKED + f"""SELECT id, source, idx::BIGINT AS paragraph_index, e AS evidence, round(coalesce({sql_common("a", "w")} / nullif(len(a), 0)::DOUBLE, 0), 4) AS score,
CASE WHEN n > 0 THEN 'consecutive_prefix' ELSE 'normalized_prefix' END AS method FROM g3""")
def provenance_of_ranges(spark, sf_dir):
    return _recovered(spark, sf_dir).where("method <> 'exact'").select("id", "source", "paragraph_index", "evidence", "score", "method")


# --- near duplicates ---------------------------------------------------------------------------------------------------


def sql_hashes(relation: str, text: str) -> str:
    """CTEs up to hashes (id, u): SimHashes of a relation with id and text."""
    return f"""hw AS (SELECT id, {sql_tokens(text)} AS w FROM {relation}),
hf AS (SELECT id, unnest(CASE WHEN len(w) < 3 THEN w ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS f FROM hw),
hh AS (SELECT id, ('0x' || substr(sha256(f), 1, 16))::UBIGINT AS h FROM hf),
hb AS (SELECT id, b, sum(CASE WHEN (h >> b) & 1 = 1 THEN 1 ELSE -1 END) AS s FROM hh, range(64) AS r(b) GROUP BY id, b),
hs AS (SELECT id, sum(CASE WHEN s >= 0 THEN 1::HUGEINT << b::INTEGER ELSE 0 END)::UBIGINT AS u FROM hb GROUP BY id),
hashes AS (SELECT hw.id, coalesce(u, 0)::UBIGINT AS u, hw.w FROM hw LEFT JOIN hs USING (id))"""


@query(_PAIRS + f""", r AS (SELECT 2 * (conv_id * 100000 + turn) AS id, question AS text FROM q UNION ALL SELECT 2 * (conv_id * 100000 + turn) + 1, regexp_replace(question, '[^ ]+$', '') FROM q), {sql_hashes("r", "text")}
SELECT x.id AS left_id, y.id AS right_id, bit_count(xor(x.u, y.u))::INTEGER AS distance FROM hashes x JOIN hashes y ON x.id < y.id WHERE bit_count(xor(x.u, y.u)) <= 14""")
def near_duplicate_questions(spark, sf_dir):
    """Questions, and each without its last word, within 14 bits: a curated set's default."""
    rows = pairs(spark, sf_dir).select((2 * (F.col("conv_id") * 100000 + F.col("turn"))).alias("id"), "question")
    rows = rows.union(rows.select(F.col("id") + 1, F.regexp_replace("question", "[^ ]+$", "")))
    return _near(rows.select("id", T.simhash(F.col("question")).alias("h")), 14)


@query(f"""WITH r AS (SELECT doc_id AS id, text FROM documents), {sql_hashes("r", "text")}
SELECT x.id AS left_id, y.id AS right_id, bit_count(xor(x.u, y.u))::INTEGER AS distance FROM hashes x JOIN hashes y ON x.id < y.id WHERE x.u <> y.u AND bit_count(xor(x.u, y.u)) <= 8""")
def near_duplicate_documents(spark, sf_dir):
    """Documents of different hashes within 8 bits; copies (equal hashes) are classes of one hash and not paired."""
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), T.simhash(F.col("text")).alias("h"))
    return _near(rows, 8, False)


def _near(rows: DataFrame, distance: int, equal: bool = True) -> DataFrame:
    rows = checkpointed(rows)  # hashes of whole texts, which are read four times
    links = dedup.near_pairs(rows.select("h"), distance)
    links = links.union(links.select("b", "a", "distance"))
    links = links.union(rows.select("h", "h", F.lit(0)).distinct()) if equal else links
    left, right = rows.toDF("left_id", "a"), rows.toDF("right_id", "b")
    found = left.join(links, "a").join(right, "b").where("left_id < right_id")
    return found.select("left_id", "right_id", F.col("distance").cast("int").alias("distance"))


# --- reviews -----------------------------------------------------------------------------------------------------------

_ALLOWED = ", ".join(f"'{k}'" for k in fixed.REGULAR_TYPES)
_CHALLENGES = ", ".join(f"'{k}'" for k in fixed.CHALLENGE_TYPES)


def _sql_consensus() -> str:
    """Two passes over labels that differ by document, as columns a_* and b_*."""
    flags = {
        "a": {"answerable": "true", "faithful": "q = 1", "supports": "d % 4 <> 0", "contained": "true", "overclaim": "x = 1", "contradiction": "false", "challenge": "d % 9 <> 0"},
        "b": {"answerable": "d % 6 <> 0", "faithful": "true", "supports": "true", "contained": "d % 8 <> 0", "overclaim": "d % 10 = 0", "contradiction": "d % 11 = 0", "challenge": "true"},
    }
    columns = ", ".join(f"({test}) AS {s}_{name}" for s, fs in flags.items() for name, test in fs.items())
    per = lambda s: [(f"strict AND NOT {s}_answerable", "judge_not_answerable"), (f"strict AND NOT {s}_faithful", "judge_not_faithful"), (f"strict AND NOT {s}_supports", "judge_evidence_not_supportive"),
                     (f"strict AND NOT {s}_contained", "judge_not_self_contained"), (f"strict AND NOT {s}_challenge", "judge_invalid_ordinary_qa")]
    low = {"a": "least(3 + d % 3, 5) < 4", "b": "5 - d % 2 < 4"}
    last = lambda s: [(f"{s}_overclaim", "judge_overclaim"), (f"{s}_contradiction", "judge_contradiction"), (f"strict AND {low[s]}", "judge_score_below_threshold")]
    either = lambda *names: " OR ".join(f"{'' if n[0] == '+' else 'NOT '}{s}_{n.lstrip('+')}" for s in "ab" for n in names)
    rules = [
        ("kind_a <> kind_b", "judge_type_disagreement"), ("NOT list_contains(allowed, kind_a) OR NOT list_contains(allowed, kind_b)", "judge_type_out_of_scope"),
        ("hard AND (kind_a <> category OR kind_b <> category)", "judge_challenge_type_mismatch"), *per("a"), *per("b"),
        (f"NOT strict AND category = 'unanswerable' AND ({either('+answerable', 'challenge', 'faithful', 'supports', 'contained')})", "invalid_unanswerable_challenge"),
        (f"NOT strict AND category = 'ambiguous' AND ({either('+answerable', '+contained', 'challenge', 'faithful')})", "invalid_ambiguous_challenge"),
        (f"NOT strict AND category = 'concept_confusion' AND ({either('challenge', 'faithful', 'supports', 'contained')})", "invalid_concept_confusion_challenge"),
        *last("a"), *last("b"),
    ]
    score = "0.0::DOUBLE" + "".join(f" + {w}::DOUBLE * ((least(3 + d % 3, 5) + (5 - d % 2)) / 2.0::DOUBLE) / 5" for w in S.WEIGHTS.values())
    return f"""WITH r AS (SELECT doc_id AS d, max(quality) AS q, max(toxic) AS x FROM labels GROUP BY doc_id),
a AS (SELECT *, d % 5 = 0 AS hard, CASE WHEN d % 5 = 0 THEN ['unanswerable', 'ambiguous', 'concept_confusion', 'cross_concept'][1 + d % 4] ELSE '' END AS category, {columns} FROM r),
k AS (SELECT *, CASE WHEN hard THEN category WHEN d % 7 = 0 THEN 'comparison' ELSE 'definition' END AS kind_a, CASE WHEN hard AND d % 3 <> 0 THEN category ELSE 'definition' END AS kind_b,
  NOT hard OR category = 'cross_concept' AS strict, CASE WHEN hard THEN [{_CHALLENGES}] ELSE [{_ALLOWED}] END AS allowed FROM a),
w AS (SELECT *, {sql_reasons(*rules)} AS ws FROM k),
z AS (SELECT d, CASE WHEN d % 13 = 0 THEN ['invalid_judge_payload'] ELSE list_filter(ws, lambda y, i: list_position(ws, y) = i) END AS ws FROM w)
SELECT doc_id, CASE WHEN z.d IS NULL THEN 'missing_judge_pass' ELSE array_to_string(ws, ',') END AS reasons,
CASE WHEN len(ws) = 0 THEN round({score} + 0.10::DOUBLE * 0.5::DOUBLE, 4) END AS quality_score FROM documents LEFT JOIN z ON z.d = doc_id"""


@query(_sql_consensus())
def disagreeing_reviews(spark, sf_dir):
    """Two passes that differ in flags, scores and types by document, over ordinary and challenge rows."""
    d, none = F.col("doc_id"), F.array().cast("array<string>")
    marks = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("q"), F.max("toxic").alias("x"))
    hard = d % 5 == 0
    category = F.when(hard, F.get(F.array(*map(F.lit, ("unanswerable", "ambiguous", "concept_confusion", "cross_concept"))), (d % 4).cast("int")))

    def payload(score: Column, kind: Column, **flags: Column) -> Column:
        own = {"answerable": F.lit(True), "faithful": F.lit(True), "evidence_supports_answer": F.lit(True), "self_contained": F.lit(True), "overclaim": F.lit(False),
               "contradiction": F.lit(False), "challenge_valid": F.lit(True)} | flags
        marks = F.struct(*(score.cast("int").alias(s) for s in consensus.SCORES))
        return F.struct(*(own[f].alias(f) for f in consensus.FLAGS), marks.alias("scores"), kind.alias("canonical_question_type"), none.alias("unsupported_claims"),
                        none.alias("reason_codes"), F.lit("").alias("reason")).cast(consensus.PAYLOAD)

    first = payload(F.when(d % 13 == 0, 9).otherwise(F.least(3 + d % 3, F.lit(5))), F.when(hard, category).when(d % 7 == 0, "comparison").otherwise("definition"),
                    faithful=F.col("q") == 1, evidence_supports_answer=d % 4 != 0, overclaim=F.col("x") == 1, challenge_valid=d % 9 != 0)
    second = payload(5 - d % 2, F.when(hard & (d % 3 != 0), category).otherwise("definition"), answerable=d % 6 != 0, self_contained=d % 8 != 0, overclaim=d % 10 == 0, contradiction=d % 11 == 0)
    judged = [marks.select("doc_id", F.lit(1).alias("line_no"), p.alias("judge_result")) for p in (first, second)]
    split = F.when(hard, "challenge").otherwise("train")
    rows = table(spark, sf_dir, "documents").select("doc_id", split.alias("split"), category.alias("challenge_category"), F.lit(0.5).alias("answer_source_overlap"))
    return consensus.build_consensus(rows, *judged, "doc_id").select("doc_id", joined("reasons").alias("reasons"), "quality_score")


# --- reports and selections --------------------------------------------------------------------------------------------


@query("""WITH m AS (SELECT event_type AS experiment, event_id % 40 AS step, min(value) AS eval_loss FROM events GROUP BY ALL)
SELECT experiment, string_agg(step || ':' || eval_loss, ',' ORDER BY step) AS evaluations FROM m GROUP BY experiment""")
def metrics_by_experiment(spark, sf_dir):
    """Events as evaluations, one a step, joined to their experiments."""
    metrics = _metrics(spark, sf_dir)
    twice = metrics.unionByName(metrics)
    found = audit.join_metrics(metrics.select("experiment").distinct(), twice)
    return found.select("experiment", joined(F.transform("evaluations", lambda x: F.concat_ws(":", x["step"].cast("string"), x["eval_loss"].cast("string")))).alias("evaluations"))


def _metrics(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("experiment"), (F.col("event_id") % 40).alias("step"))
    return rows.agg(F.min("value").alias("eval_loss"))


@query("""WITH m AS (SELECT event_type AS experiment, event_id % 40 AS step, min(value) AS eval_loss FROM events GROUP BY ALL)
SELECT experiment, (row_number() OVER (PARTITION BY experiment ORDER BY step))::INTEGER AS place, step / 40.0::DOUBLE AS epoch, eval_loss FROM m""")
def loss_curves(spark, sf_dir):
    """What a plot of the losses draws: each experiment's points in the order of their epochs."""
    return audit.loss_curves(_metrics(spark, sf_dir).withColumn("epoch", F.col("step") / 40)).select("experiment", "place", "epoch", "eval_loss")


@query("SELECT event_type AS experiment, min(value) AS eval_loss FROM events GROUP BY 1 ORDER BY 2 LIMIT 1")
def best_experiment(spark, sf_dir):
    """Of equal losses, that of the experiment that the table has first."""
    rows = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("experiment"))
    rows = rows.agg(F.min("value").alias("eval_loss"), F.min("event_id").alias("first"))
    return audit.best_experiment(rows, order="first").drop("first")


@query("""WITH s AS (SELECT 'all' AS stage, lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang UNION ALL
SELECT 'labelled', lang, count(*) FROM documents WHERE lang IS NOT NULL AND doc_id IN (SELECT doc_id FROM labels) GROUP BY lang UNION ALL
SELECT 'odd', lang, count(*) FROM documents WHERE lang IS NOT NULL AND doc_id % 2 = 1 GROUP BY lang)
SELECT lang, coalesce(max(n) FILTER (stage = 'all'), 0)::BIGINT AS all_rows, coalesce(max(n) FILTER (stage = 'labelled'), 0)::BIGINT AS labelled, coalesce(max(n) FILTER (stage = 'odd'), 0)::BIGINT AS odd FROM s GROUP BY lang""")
def stage_matrix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("lang is not null")
    stages = {"all_rows": docs, "labelled": docs.join(table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_semi"), "odd": docs.where("doc_id % 2 = 1")}
    return audit.status_matrix(stages, "lang")


@query("""WITH q AS (SELECT unnest(['en', 'fr', 'xx']) AS lang, unnest([30, 100000000, 5]) AS target), c AS (SELECT lang, least(count(*), 100000000) AS n FROM documents WHERE source IS NOT NULL GROUP BY lang)
SELECT q.lang, (target - coalesce(n, 0))::BIGINT AS missing FROM q LEFT JOIN c USING (lang) WHERE target > coalesce(n, 0)""")
def quota_deficits(spark, sf_dir):
    """What languages lack of their quotas without a cap that binds; the selection itself is not returned."""
    rows = table(spark, sf_dir, "documents").where("source is not null").select(F.col("doc_id").alias("id"), "lang", "source", F.col("n_chars").alias("score"))
    quotas = {"en": 30, "fr": 100_000_000, "xx": 5}
    return selection.quota_deficits(rows, quotas, "lang")


@query("""SELECT source, string_agg(doc_id, ',' ORDER BY doc_id) AS ids FROM documents WHERE source IS NOT NULL AND doc_id IN (SELECT doc_id FROM labels) GROUP BY source""")
def labelled_by_source(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("source is not null").join(table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    lists = docs.groupBy("source").agg(F.array_sort(F.collect_list("doc_id")).alias("ids"))
    return lists.select("source", joined(F.transform("ids", lambda x: x.cast("string"))).alias("ids"))


@query(f"""WITH a AS (SELECT doc_id, {sql_fp("text")} AS fp, CASE WHEN source IN ('src3', 'src4') THEN 0 ELSE 1 END AS p FROM documents)
SELECT doc_id, CASE WHEN row_number() OVER w > 1 THEN 'exact_text' END AS duplicate_reason, CASE WHEN row_number() OVER w > 1 THEN first(doc_id) OVER w END AS duplicate_of FROM a WINDOW w AS (PARTITION BY fp ORDER BY p, doc_id)""")
def global_dedup_by_precedence(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", F.when(F.col("source").isin("src3", "src4"), 0).otherwise(1).alias("p"), T.fingerprint(F.col("text")).alias("k"))
    found = dedup.greedy_deduplicate(rows, "doc_id", [F.col("p"), F.col("doc_id")], [dedup.Rule("exact_text", "k")])
    return found.select("doc_id", "duplicate_reason", "duplicate_of")


_FIRST = _PAIRS + f""", s AS (SELECT *, 1000 - abs(length(answer) - 1200) + CASE WHEN contains(question, '?') THEN 50 ELSE 0 END + 25 AS score FROM q
WHERE length(question) >= 10 AND length(answer) BETWEEN 120 AND 6000 AND NOT {sql_any("lower(answer)", gates.LEGACY_PLACEHOLDERS)})"""


@query(_FIRST + "SELECT conv_id, turn, score::INTEGER AS score FROM s")
def training_rows(spark, sf_dir):
    rows = pairs(spark, sf_dir).withColumns({"source": F.lit("conversations"), "mojibake": F.lit(0)})
    return gates.training_rows(rows, source="source", mojibake="mojibake").select("conv_id", "turn", F.col("score").cast("int").alias("score"))


@query(_FIRST + """, b AS (SELECT conv_id, turn, 'c' || conv_id % 10 AS source, row_number() OVER (ORDER BY score DESC, conv_id, turn) AS place FROM s)
SELECT (SELECT count(*) FROM b WHERE place <= 150)::BIGINT AS n, 0::BIGINT AS shared_sources, (SELECT count(DISTINCT source) FROM b WHERE place <= 150)::BIGINT AS sources""")
def top_n_by_source(spark, sf_dir):
    """The best 150 in training and validation rows of different sources: their number, and sources in both."""
    rows = gates.training_rows(pairs(spark, sf_dir).withColumns({"source": F.concat(F.lit("c"), (F.col("conv_id") % 10).cast("string")), "mojibake": F.lit(0)}), source="source", mojibake="mojibake")
    train, validation = selection.top_n_split(rows.withColumn("line_no", F.col("conv_id") * 100000 + F.col("turn")), 150, 0.1, 3407)
    both = train.select("source", F.lit(1).alias("t"), F.lit(0).alias("v")).union(validation.select("source", F.lit(0), F.lit(1)))
    by_source = both.groupBy("source").agg(F.count("*").alias("n"), F.max("t").alias("t"), F.max("v").alias("v"))
    return by_source.agg(F.sum("n").alias("n"), F.count_if((F.col("t") == 1) & (F.col("v") == 1)).alias("shared_sources"), F.count("*").alias("sources"))


@query("SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 25")
def first_rows(spark, sf_dir):
    """A report of the first 25: the limit is the feature."""
    return selection.first_rows(table(spark, sf_dir, "documents").select("doc_id", "source"), 25, "doc_id")


# --- SQL of queries whose DataFrames stand in the catalogue --------------------------------------------------------------

SQL["greedy_dedup_near"] = f"""WITH RECURSIVE r AS (SELECT doc_id AS id, text FROM documents), {sql_hashes("r", "text")},
x AS (SELECT h.id, u, sha256(array_to_string(w, ' ')) AS k, row_number() OVER (ORDER BY CASE WHEN source IN ('src3', 'src4') THEN 0 ELSE 1 END, len(w) DESC, h.id) AS rk
  FROM hashes h JOIN documents ON doc_id = h.id),
g AS (SELECT 0::BIGINT AS rk, -1::BIGINT AS id, false AS dup, []::VARCHAR[] AS ks, []::UBIGINT[] AS us
  UNION ALL SELECT rk, id, dup, CASE WHEN dup THEN ks ELSE list_append(ks, k) END, CASE WHEN dup THEN us ELSE list_append(us, u) END
  FROM (SELECT x.rk, x.id, x.k, x.u, g.ks, g.us, list_contains(g.ks, x.k) OR len(list_filter(g.us, lambda v: bit_count(xor(v, x.u)) <= 8)) > 0 AS dup FROM g JOIN x ON x.rk = g.rk + 1)),
kept AS (SELECT x.* FROM x JOIN g USING (id) WHERE NOT dup),
why AS (SELECT x.id, 0 AS n, 0 AS distance, kept.id AS other FROM x JOIN kept ON kept.k = x.k AND kept.rk < x.rk
  UNION ALL SELECT x.id, 1, bit_count(xor(kept.u, x.u))::INTEGER, kept.id FROM x JOIN kept ON kept.rk < x.rk AND bit_count(xor(kept.u, x.u)) <= 8),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n, distance, other) AS place FROM why) WHERE place = 1)
SELECT x.id AS doc_id, CASE n WHEN 0 THEN 'exact_text' WHEN 1 THEN 'near_text' END AS duplicate_reason, other AS duplicate_of, distance AS duplicate_distance
FROM x LEFT JOIN best ON best.id = x.id"""

_RULES = generation.HardRules()
_BETWEEN = lambda c, bounds: f"NOT (length({c}) BETWEEN {bounds[0]} AND {bounds[1]})"
SQL["hard_filter_reasons"] = f"""WITH d AS (SELECT doc_id, text AS source, {sql_clean("'What do the words ' || substr(text, 1, 80) || ' mean?'")} AS ask,
  {sql_clean("'They say that ' || substr(text, 81, 400) || '.'")} AS told, {sql_clean("substr(text, 81, 120)")} AS quote FROM documents WHERE text IS NOT NULL),
h AS (SELECT *, {sql_tokens("told")} AS aw, {sql_content("told")} AS ac, {sql_content("source")} AS sc, array_to_string({sql_tokens("source")}, ' ') AS sk FROM d),
rep AS {sql_repeated("h", "doc_id", "aw")}, {sql_span("quote", "source", "h")},
o AS (SELECT *, CASE WHEN len(ac) > 0 THEN len(list_intersect(ac, sc)) / len(ac)::DOUBLE ELSE 0 END AS share FROM h_s),
w AS (SELECT *, {sql_reasons(
    (_BETWEEN("ask", _RULES.question), "question_length"), ("NOT ends_with(ask, '?')", "question_not_interrogative"), (sql_any("lower(ask)", gates.META_QUESTIONS), "meta_question"),
    (sql_any("lower(ask)", generation.GENERIC), "generic_source_reference"), (sql_any("lower(ask)", generation.AMBIGUOUS), "ambiguous_question_reference"),
    (_BETWEEN("told", _RULES.answer), "answer_length"), (sql_any("lower(told)", gates.PLACEHOLDERS), "placeholder_or_refusal"), (sql_any("lower(told)", generation.GENERIC), "generic_source_reference"),
    ("doc_id IN (SELECT doc_id FROM rep)", "repetitive_answer"), ("quote = ''", "evidence_quote_count"), ("quote <> '' AND " + _BETWEEN("quote", _RULES.quote), "evidence_quote_length"),
    (f"NOT ({_BETWEEN('quote', _RULES.quote)}) AND start_at IS NULL", "evidence_quote_not_contiguous"), (f"share < {_RULES.min_overlap}", "low_answer_source_overlap"),
    (f"len(aw) >= {_RULES.copy_tokens} AND contains(sk, array_to_string(aw, ' '))", "long_direct_copy"))} AS ws FROM o)
SELECT doc_id::VARCHAR AS candidate_id, array_to_string(list_filter(ws, lambda y, i: list_position(ws, y) = i), ',') AS reasons, round(share, 4) AS answer_source_overlap,
round(0.7::DOUBLE * share + 0.3::DOUBLE * 1.0::DOUBLE, 4) AS hard_quality_score, CASE WHEN {_BETWEEN("quote", _RULES.quote)} OR start_at IS NULL THEN '' ELSE start_at || ':' || end_at END AS spans FROM w"""
