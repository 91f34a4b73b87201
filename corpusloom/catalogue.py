"""Every query of the engine by name, with production parameters over whole tables, and its SQL.

Columns are cast alike on both sides: counts and flags to BIGINT and INTEGER, scores to DOUBLE, arrays to joined strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions import fixed
from corpusloom.functions import scores as S
from corpusloom.functions import text as T
from corpusloom.operators import audit, consensus, dedup, gates, generation, provenance, selection
from corpusloom.plans import evaluation, training
from corpusloom.sources.tables import checkpointed, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql.strip()
        return f

    return register


def joined(c) -> Column:
    return F.array_join(c, ",")


# --- pieces of SQL -----------------------------------------------------------------------------------------------------

_WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def sql_clean(c: str) -> str:
    return rf"regexp_replace(regexp_replace(replace(coalesce({c}, ''), chr(65279), ''), '{_WS}+', ' ', 'g'), '^ | $', '', 'g')"


def sql_tokens(c: str) -> str:
    return f"list_transform(regexp_extract_all({sql_clean(c)}, '(?i)[a-z0-9]+(?:[''’][a-z0-9]+)?'), lambda x: lower(replace(x, '’', '''')))"


def sql_fp(c: str) -> str:
    return f"sha256(array_to_string({sql_tokens(c)}, ' '))"


def sql_any(c: str, terms) -> str:
    quote = lambda t: t.replace("'", "''")
    return "(" + " OR ".join(f"contains({c}, '{quote(t)}')" for t in terms) + ")"


def sql_alpha(c: str) -> str:
    return f"(CASE WHEN length({c}) > 0 THEN length(regexp_replace({c}, '[^A-Za-z]', '', 'g')) / length({c})::DOUBLE ELSE 0.0 END)"


def sql_reasons(*rules: tuple[str, str]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {test} THEN '{name}' END" for test, name in rules) + "], lambda r: r IS NOT NULL)"


def sql_repeated(source: str, key: str, tokens: str, n: int = 8, times: int = 3) -> str:
    """Keys of rows whose tokens repeat an n-gram."""
    return f"""(SELECT DISTINCT {key} FROM (SELECT {key}, array_to_string({tokens}[i:i + {n - 1}], ' ') AS g FROM (
SELECT {key}, {tokens}, unnest(range(1, len({tokens}) - {n - 2})) AS i FROM {source} WHERE len({tokens}) >= {n * times}))
GROUP BY {key}, g HAVING count(*) >= {times})"""


_CLEAN = f"""
WITH a AS (SELECT doc_id, source, {sql_clean("text")} AS t FROM documents),
b AS (SELECT *, {sql_tokens("t")} AS w FROM a),
rep AS {sql_repeated("b", "doc_id", "w")},
c AS (SELECT doc_id, source, t, w, sha256(array_to_string(w, ' ')) AS fp, {sql_reasons(
    ("NOT (length(t) BETWEEN 240 AND 1800)", "length"), (sql_any("lower(t)", gates.BOILERPLATE), "publisher_metadata"),
    (sql_any("t", gates.MOJIBAKE), "mojibake"), (sql_alpha("t") + " < 0.6", "low_alphabetic_ratio"),
    ("doc_id IN (SELECT doc_id FROM rep)", "repeated_ngram"))} AS r FROM b),
d AS (SELECT *, min(doc_id) FILTER (WHERE len(r) = 0 AND coalesce(source, '') <> '') OVER (PARTITION BY fp) AS m FROM c),
e AS (SELECT *, list_concat(list_concat(r, CASE WHEN doc_id > m THEN ['exact_duplicate'] ELSE [] END),
  CASE WHEN coalesce(source, '') = '' THEN ['missing_provenance'] ELSE [] END) AS why FROM d)
"""

_PAIRS = f"""
WITH p AS (SELECT conv_id, turn, role, text, lead(role) OVER w AS next_role, lead(text) OVER w AS answer FROM conversations
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
q AS (SELECT conv_id, turn, {sql_clean("text")} AS question, {sql_clean("answer")} AS answer FROM p WHERE role = 'user' AND next_role = 'assistant')
"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant's next one."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, sf_dir, "conversations")
    rows = rows.withColumns({"next_role": F.lead("role").over(w), "answer": F.lead("text").over(w)})
    rows = rows.where("role = 'user' and next_role = 'assistant'").select("conv_id", "turn", F.col("text").alias("question"), "answer")
    return T.with_nfkc(rows, "question", "answer").withColumns({c: T.clean_text(F.col(c)) for c in ("question", "answer")})


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.with_nfkc(table(spark, sf_dir, "documents"), "text")


def cleaned(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return gates.clean_corpus(table(spark, sf_dir, "documents"), order="doc_id", keep=columns)


# --- text --------------------------------------------------------------------------------------------------------------


@query(f"SELECT doc_id, {sql_clean('text')} AS cleaned FROM documents")
def clean_human_text(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.clean_text(F.col("text")).alias("cleaned"))


@query(f"SELECT doc_id, len({sql_tokens('text')})::BIGINT AS n_tokens FROM documents")
def word_token_counts(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.size(T.tokens(F.col("text"))).cast("bigint").alias("n_tokens"))


@query(f"SELECT doc_id, {sql_fp('text')} AS fingerprint FROM documents")
def fingerprints(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.fingerprint(F.col("text")).alias("fingerprint"))


@query(f"""SELECT doc_id, {sql_fp(f"coalesce(source, '') || ':' || doc_id || ':' || {sql_clean('text')}")} AS paragraph_id,
sha256(coalesce(text, '')) AS raw_sha256 FROM documents""")
def paragraph_ids(spark, sf_dir):
    name = F.concat(F.coalesce("source", F.lit("")), F.lit(":"), F.col("doc_id").cast("string"), F.lit(":"), T.clean_text(F.col("text")))
    raw = table(spark, sf_dir, "documents").withColumn("raw_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    return T.with_nfkc(raw, "text").select("doc_id", T.fingerprint(name).alias("paragraph_id"), "raw_sha256")


_HASH = f"""
WITH a AS (SELECT item_id AS id, {sql_tokens("text")} AS w FROM benchmark),
f AS (SELECT id, unnest(CASE WHEN len(w) < 3 THEN w ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS f FROM a),
h AS (SELECT id, ('0x' || substr(sha256(f), 1, 16))::UBIGINT AS h FROM f),
b AS (SELECT id, b, sum(CASE WHEN (h >> b) & 1 = 1 THEN 1 ELSE -1 END) AS s FROM h, range(64) AS r(b) GROUP BY id, b),
s AS (SELECT id, sum(CASE WHEN s >= 0 THEN 1::HUGEINT << b::INTEGER ELSE 0 END)::UBIGINT AS u FROM b GROUP BY id)
"""


@query(_HASH + "SELECT a.id AS item_id, lower(lpad(to_hex(coalesce(u, 0)), 16, '0')) AS simhash FROM a LEFT JOIN s USING (id)")
def simhash(spark, sf_dir):
    rows = table(spark, sf_dir, "benchmark").select("item_id", T.simhash(F.col("text")).alias("h"))
    return rows.select("item_id", F.lower(F.lpad(F.hex("h"), 16, "0")).alias("simhash"))


# --- cleaning ----------------------------------------------------------------------------------------------------------


@query(_CLEAN + "SELECT doc_id, fp AS fingerprint, array_to_string(why, ',') AS reasons FROM e")
def clean_reasons(spark, sf_dir):
    return cleaned(spark, sf_dir, "fingerprint").select("doc_id", "fingerprint", joined("reasons").alias("reasons"))


@query(_CLEAN + "SELECT doc_id, source, t AS cleaned_text, fp AS fingerprint FROM e WHERE len(why) = 0")
def clean_accepted(spark, sf_dir):
    return gates.split_by(cleaned(spark, sf_dir, "cleaned_text", "fingerprint"))[0].select("doc_id", "source", "cleaned_text", "fingerprint")


@query(_CLEAN + "SELECT reason, count(*)::BIGINT AS n FROM (SELECT unnest(why) AS reason FROM e) GROUP BY reason")
def clean_rejection_counts(spark, sf_dir):
    return gates.reason_counts(cleaned(spark, sf_dir))


@query(f"""WITH a AS (SELECT doc_id, {sql_tokens('text')} AS w FROM documents)
SELECT doc_id, (doc_id IN {sql_repeated('a', 'doc_id', 'w')})::INTEGER AS repeated FROM a""")
def repeated_ngram(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.repeated_ngram(T.tokens(F.col("text"))).cast("int").alias("repeated"))


@query(f"SELECT doc_id, round({sql_alpha(sql_clean('text'))}, 6) AS ratio FROM documents")
def alphabetic_ratio(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", T.clean_text(F.col("text")).alias("t"))
    return rows.select("doc_id", F.round(T.alphabetic_ratio(F.col("t")), 6).alias("ratio"))


def sql_quality(c: str) -> str:
    return f"round(1 - least(abs(length({c}) - 700) / 7000.0::DOUBLE, 0.2::DOUBLE), 4)"


def sql_hits(low: str, signals) -> str:
    return "(" + " + ".join(f"(length({low}) - length(replace({low}, '{s}', ''))) // {len(s)}" for s in signals) + ")"


def sql_fit(t: str, low: str, kind: str) -> str:
    out = f"0.65::DOUBLE * {sql_quality(t)} + 0.07::DOUBLE * least({sql_hits(low, S.SIGNALS[kind])}, 5) + 0.025::DOUBLE * least({sql_hits(low, S.CONCEPTS)}, 4)"
    if kind == "textual_interpretation":
        out += f" + CASE WHEN {sql_any(t, fixed.QUOTE_MARKS)} THEN 0.08::DOUBLE ELSE 0 END"
    if kind == "definition":
        out += f" - CASE WHEN {sql_any(low, S.MEETING)} THEN 0.15::DOUBLE ELSE 0 END"
    return f"round({out}, 4)"


@query(
    f"WITH a AS (SELECT doc_id, {sql_clean('text')} AS t FROM documents), b AS (SELECT *, lower(t) AS l FROM a) "
    + " UNION ALL ".join(f"SELECT doc_id, '{k}' AS kind, {sql_fit('t', 'l', k)} AS suitability FROM b" for k in S.SIGNALS)
)
def type_suitability(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", T.clean_text(F.col("text")).alias("t"))
    rows = rows.withColumn("low", F.lower("t")).withColumn("concepts", S.signal_hits(F.col("low"), S.CONCEPTS))
    fit = lambda k: S.type_suitability(F.col("t"), k, F.col("low"), F.col("concepts"))
    fits = F.array(*(F.struct(F.lit(k).alias("kind"), fit(k).alias("suitability")) for k in S.SIGNALS))
    return rows.select("doc_id", F.inline(fits))


_LEGACY = rf"""
WITH blocks AS (SELECT doc_id, unnest(string_split_regex(text, '\n')) AS raw, generate_subscripts(string_split_regex(text, '\n'), 1) AS pos FROM documents WHERE text IS NOT NULL)
SELECT doc_id, pos::INTEGER AS line, {sql_clean("raw")} AS paragraph FROM blocks WHERE length({sql_clean("raw")}) BETWEEN 120 AND 6000
AND length({sql_clean("raw")}) - length(replace({sql_clean("raw")}, ' ', '')) >= 10 AND NOT {sql_any(f"lower({sql_clean('raw')})", generation.LEGACY_BOILERPLATE)}
AND NOT {sql_any(sql_clean("raw"), gates.MOJIBAKE)} AND NOT (contains({sql_clean("raw")}, '|') AND len(string_split({sql_clean("raw")}, ' ')) < 35)
"""


@query(_LEGACY)
def text_lines(spark, sf_dir):
    """Usable lines of whole texts."""
    rows = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "raw"))
    rows = rows.select("doc_id", (F.col("pos") + 1).alias("line"), T.clean_text(F.col("raw")).alias("paragraph"))
    return rows.where(generation.useful_paragraph(F.col("paragraph")))


# --- questions and answers ---------------------------------------------------------------------------------------------

_KIND = f"""CASE WHEN {sql_any("lower(question)", fixed.COMPARISON_TERMS)} THEN 'comparison'
WHEN {sql_any("lower(question)", fixed.CLINICAL_TERMS)} THEN 'clinical'
WHEN starts_with(lower(question), 'what is ') OR starts_with(lower(question), 'what are ') THEN 'definition'
WHEN {sql_any("lower(question)", fixed.EXPLANATION_TERMS)} THEN 'explanation'
WHEN {sql_any("lower(question)", fixed.TEXTUAL_TERMS)} THEN 'textual_interpretation' ELSE 'other' END"""


@query(_PAIRS + f"SELECT conv_id, turn, {_KIND} AS question_type FROM q")
def classify_question(spark, sf_dir):
    return pairs(spark, sf_dir).select("conv_id", "turn", gates.classify_question(F.col("question")).alias("question_type"))


_QUALITY = _PAIRS + f""", k AS (SELECT *, conv_id * 100000 + turn AS id, {sql_tokens("answer")} AS w FROM q), rep AS {sql_repeated("k", "id", "w")},
r AS (SELECT *, {sql_reasons(
    ("NOT (length(question) BETWEEN 20 AND 300)", "question_length"), ("NOT ends_with(question, '?')", "question_not_interrogative"),
    (sql_any("lower(question)", gates.META_QUESTIONS), "meta_question"), ("NOT (length(answer) BETWEEN 80 AND 1600)", "answer_length"),
    (sql_any("lower(answer)", gates.PLACEHOLDERS), "placeholder_answer"), (sql_any("lower(answer)", gates.BOILERPLATE), "boilerplate"),
    (sql_any("answer", gates.MOJIBAKE), "mojibake"), ("id IN (SELECT id FROM rep)", "repetitive_answer"),
    ("answer <> '' AND " + sql_alpha("answer") + " < 0.55", "low_alphabetic_ratio"))} AS why FROM k)
SELECT conv_id, turn, {_KIND} AS question_type, array_to_string(why, ',') AS reasons, round(greatest(1 - least(abs(length(answer) - 650) / 5000.0::DOUBLE, 0.15::DOUBLE)
 - least(abs(length(question) - 110) / 2000.0::DOUBLE, 0.08::DOUBLE) - 0.08::DOUBLE * len(why), 0.0::DOUBLE), 4) AS quality_score FROM r"""


@query(_QUALITY)
def assess_quality(spark, sf_dir):
    rows = gates.assess_quality(pairs(spark, sf_dir))
    return rows.select("conv_id", "turn", "question_type", joined("reasons").alias("reasons"), "quality_score")


@query(_PAIRS + f""", v AS (SELECT *, conv_id * 100000 + turn AS line_no, {sql_clean("question || chr(10) || answer")} AS k,
CASE WHEN length(question) < 12 OR NOT contains(question, '?') THEN 'invalid_question' WHEN NOT (length(answer) BETWEEN 120 AND 6000) THEN 'invalid_answer_length'
WHEN {sql_any("answer", gates.MOJIBAKE)} THEN 'mojibake' WHEN {sql_any("lower(answer)", gates.LEGACY_PLACEHOLDERS)} THEN 'refusal_or_placeholder'
WHEN {sql_any("lower(answer)", gates.BOILERPLATE)} THEN 'boilerplate' END AS reason FROM q),
d AS (SELECT *, min(line_no) FILTER (WHERE reason IS NULL) OVER (PARTITION BY lower(k)) AS m FROM v)
SELECT conv_id, turn, CASE WHEN reason IS NULL AND line_no > m THEN 'duplicate' ELSE reason END AS reason, length(answer)::INTEGER AS char_count FROM d""")
def legacy_validate(spark, sf_dir):
    rows = pairs(spark, sf_dir).withColumn("line_no", F.col("conv_id") * 100000 + F.col("turn"))
    return gates.legacy_validate(rows).select("conv_id", "turn", "reason", F.length("answer").alias("char_count"))


@query(_PAIRS + f""", s AS (SELECT *, 1000 - abs(length(answer) - 1200) + CASE WHEN contains(question, '?') THEN 50 ELSE 0 END AS score FROM q
WHERE length(question) >= 10 AND length(answer) BETWEEN 120 AND 6000 AND NOT {sql_any("lower(answer)", gates.LEGACY_PLACEHOLDERS)})
SELECT conv_id, turn, score::INTEGER AS score, (row_number() OVER (ORDER BY score DESC, conv_id, turn))::INTEGER AS place FROM s
ORDER BY score DESC, conv_id, turn LIMIT 100""")
def legacy_top_n(spark, sf_dir):
    """A top-100 report: the limit is the feature."""
    rows = gates.training_rows(pairs(spark, sf_dir))
    best = rows.select("conv_id", "turn", F.col("score").cast("int").alias("score")).orderBy(F.desc("score"), "conv_id", "turn").limit(100)
    place = F.row_number().over(Window.orderBy(F.desc("score"), "conv_id", "turn"))
    return best.withColumn("place", place)


def sql_content(c: str) -> str:
    words = ", ".join(f"'{w}'" for w in T.STOPWORDS)
    return f"list_distinct(list_filter({sql_tokens(c)}, lambda t: length(t) > 2 AND NOT list_contains([{words}], t)))"


@query(_PAIRS + f""", c AS (SELECT conv_id, turn, {sql_content("answer")} AS a, {sql_content("question")} AS s FROM q)
SELECT conv_id, turn, CASE WHEN len(a) > 0 THEN round(len(list_intersect(a, s)) / len(a)::DOUBLE, 4) ELSE 0.0 END AS overlap FROM c""")
def token_overlap(spark, sf_dir):
    rows = pairs(spark, sf_dir)
    return rows.select("conv_id", "turn", F.round(T.overlap(T.content_tokens(F.col("answer")), T.content_tokens(F.col("question"))), 4).alias("overlap"))


@query(f"""WITH a AS (SELECT doc_id, unnest(string_split(regexp_replace({sql_clean("text")}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1))) AS s FROM documents)
SELECT doc_id, count(*)::BIGINT AS n_sentences, max(length(s))::INTEGER AS longest FROM a GROUP BY doc_id""")
def sentence_split(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", F.explode(T.sentences(T.clean_text(F.col("text")))).alias("s"))
    return rows.groupBy("doc_id").agg(F.count("*").alias("n_sentences"), F.max(F.length("s")).alias("longest"))


# --- provenance --------------------------------------------------------------------------------------------------------

def paragraph_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "raw"))
    rows = rows.select(
        F.col("doc_id").cast("string").alias("source"), F.col("pos").alias("paragraph_index"), T.clean_text(F.col("raw")).alias("text"),
        (F.col("doc_id") * 100000 + F.col("pos")).alias("line_no"),
    )
    return provenance.paragraph_index(rows)


@query("""SELECT b.item_id, d.doc_id, (strpos(d.text, b.text) - 1)::INTEGER AS start_at, (strpos(d.text, b.text) - 1 + length(b.text))::INTEGER AS end_at
FROM documents d JOIN benchmark b ON contains(d.text, b.text)""")
def verbatim_spans(spark, sf_dir):
    return generation.verbatim(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# --- de-duplication ----------------------------------------------------------------------------------------------------


@query(f"""WITH a AS (SELECT doc_id, {sql_fp("text")} AS fp FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY fp) AS first_id FROM a""")
def exact_dedup(spark, sf_dir):
    rows = checkpointed(documents(spark, sf_dir).select("doc_id", T.fingerprint(F.col("text")).alias("fp")))
    return rows.join(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fp").select("doc_id", "first_id")


@query(f"""WITH RECURSIVE a AS (SELECT item_id, {sql_tokens("text")} AS w FROM benchmark),
x AS (SELECT item_id, array_to_string(w, ' ') AS k, array_to_string(w[1:2], ' ') AS p, row_number() OVER (ORDER BY length(array_to_string(w, ' ')) DESC, item_id) AS r FROM a),
g AS (SELECT 0::BIGINT AS r, []::VARCHAR[] AS ks, []::VARCHAR[] AS ps, -1::BIGINT AS item_id, false AS kept
  UNION ALL SELECT x.r, CASE WHEN list_contains(g.ks, x.k) OR list_contains(g.ps, x.p) THEN g.ks ELSE list_append(g.ks, x.k) END,
  CASE WHEN list_contains(g.ks, x.k) OR list_contains(g.ps, x.p) THEN g.ps ELSE list_append(g.ps, x.p) END, x.item_id,
  NOT (list_contains(g.ks, x.k) OR list_contains(g.ps, x.p)) FROM g JOIN x ON x.r = g.r + 1)
SELECT item_id, kept::INTEGER AS kept FROM g WHERE r > 0""")
def greedy_dedup(spark, sf_dir):
    """Benchmark items, longest first: equal texts, or equal first two words, of a kept item go."""
    rows = T.with_nfkc(table(spark, sf_dir, "benchmark"), "text").select("item_id", T.tokens(F.col("text")).alias("w"))
    rows = rows.select("item_id", F.array_join("w", " ").alias("k"), T.prefix_signature(F.col("w"), 2).alias("p"))
    rules = [dedup.Rule("exact_text", "k"), dedup.Rule("exact_start", "p")]
    found = dedup.greedy_deduplicate(rows, "item_id", [-F.length("k"), F.col("item_id")], rules)
    return found.select("item_id", F.col("duplicate_reason").isNull().cast("int").alias("kept"))


@query()
def greedy_dedup_near(spark, sf_dir):
    """All documents by precedence of split (test sources first), then length: exact, then near (SimHash within 8) duplicates."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", T.simhash(F.col("text")).alias("h"), T.nfkc(F.col("text")).alias("t"))
    rows = rows.select("doc_id", "source", "h", T.tokens(F.col("t")).alias("w"))
    rows = rows.select("doc_id", F.when(F.col("source").isin("src3", "src4"), 0).otherwise(1).alias("precedence"), F.size("w").alias("n"),
                       F.sha2(F.array_join("w", " "), 256).alias("k"), "h")
    rules = [dedup.Rule("exact_text", "k"), dedup.Rule("near_text", "h", 8)]
    found = dedup.greedy_deduplicate(rows, "doc_id", [F.col("precedence"), -F.col("n"), F.col("doc_id")], rules)
    return found.select("doc_id", "duplicate_reason", "duplicate_of", "duplicate_distance")


@query(f"""WITH u AS (SELECT 'benchmark' AS split, 0 AS precedence, item_id AS id, {sql_fp("text")} AS fp FROM benchmark
UNION ALL SELECT 'documents', 1, doc_id, {sql_fp("text")} FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY fp ORDER BY precedence, id) AS n FROM u)
SELECT split, id, (n = 1)::INTEGER AS kept FROM r""")
def global_dedup_precedence(spark, sf_dir):
    items = T.with_nfkc(table(spark, sf_dir, "benchmark"), "text").select(F.lit("benchmark").alias("split"), F.lit(0).alias("precedence"), F.col("item_id").alias("id"), "text")
    docs = documents(spark, sf_dir).select(F.lit("documents").alias("split"), F.lit(1).alias("precedence"), F.col("doc_id").alias("id"), "text")
    rows = checkpointed(items.unionByName(docs).select("split", "precedence", "id", T.fingerprint(F.col("text")).alias("fp")))
    first = rows.groupBy("fp").agg(F.min(F.struct("precedence", "id")).alias("first"))
    rows = rows.join(first, "fp")
    return rows.select("split", "id", (F.struct("precedence", "id") == F.col("first")).cast("int").alias("kept"))


# --- splits, selection, reports ----------------------------------------------------------------------------------------

VALIDATION, TEST = ("src1", "src2", "src5"), ("src3", "src4", "src6")
_SPLIT = "CASE WHEN source IN ('src1', 'src2', 'src5') THEN 'validation' WHEN source IN ('src3', 'src4', 'src6') THEN 'test' ELSE 'train' END"


@query("SELECT source, count(*)::BIGINT AS n FROM documents GROUP BY source")
def source_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))


@query(f"SELECT {_SPLIT} AS split, count(*)::BIGINT AS n, count(DISTINCT source)::BIGINT AS sources FROM documents GROUP BY 1")
def split_manifest(spark, sf_dir):
    rows = selection.assign_splits(table(spark, sf_dir, "documents"), VALIDATION, TEST)
    return rows.groupBy("split").agg(F.count("*").alias("n"), F.countDistinct("source").alias("sources"))


@query(f"""WITH a AS (SELECT {_SPLIT} AS split, {sql_fp("text")} AS fp FROM documents)
SELECT fp AS fingerprint FROM a WHERE split = 'train' INTERSECT SELECT fp FROM a WHERE split = 'test'""")
def split_leakage(spark, sf_dir):
    rows = selection.assign_splits(documents(spark, sf_dir), VALIDATION, TEST).select("split", T.fingerprint(F.col("text")).alias("fingerprint"))
    return selection.leaked(rows.where("split = 'train'"), rows.where("split = 'test'"), "fingerprint")


QUOTAS, CAP = {"en": 40, "fr": 20, "de": 15, "es": 10}, 6


def _quota_sql() -> str:
    out, before = ["s0 AS (SELECT doc_id AS id, lang, source, n_chars AS score FROM documents WHERE source IS NOT NULL)"], []
    for i, (lang, target) in enumerate(QUOTAS.items(), 1):
        load = " + ".join(f"(SELECT count(*) FROM s{j} WHERE s{j}.source = r.source)" for j in before) or "0"
        out.append(f"""s{i} AS (SELECT id, lang, source, score FROM (SELECT *, n + {load} AS load FROM (SELECT *, row_number() OVER (PARTITION BY source
ORDER BY score DESC, id) - 1 AS n FROM s0 WHERE lang = '{lang}') r) WHERE load < {CAP} ORDER BY load, score DESC, id LIMIT {target})""")
        before.append(i)
    return "WITH " + ", ".join(out) + " ".join(f"{' UNION ALL' if j > 1 else ''} SELECT id, lang, source FROM s{j}" for j in before)


@query(_quota_sql())
def select_with_quotas(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").where("source is not null").select(F.col("doc_id").alias("id"), "lang", "source", F.col("n_chars").alias("score"))
    return selection.select_with_quotas(rows, QUOTAS, CAP, id_col="id", kind="lang", source="source", score="score")[0].select("id", "lang", "source")


@query()
def select_source_cap(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").where("source is not null and lang is not null")
    ids = selection.select_with_source_cap(rows, 60, 6, "doc_id", "lang", "source", ["n_chars"])
    return spark.createDataFrame([(i + 1, d) for i, d in enumerate(ids)], "place int, doc_id long")


@query(f"""WITH a AS (SELECT doc_id, source, {sql_clean("text")} AS t FROM documents WHERE source IS NOT NULL),
b AS (SELECT *, {sql_fit("t", "lower(t)", "explanation")} AS fit FROM a),
c AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY fit DESC, doc_id DESC) - 1 AS turn FROM b)
SELECT doc_id, source, turn::INTEGER AS turn, fit AS suitability FROM c WHERE turn < 4 ORDER BY turn, source LIMIT 50""")
def generation_queue(spark, sf_dir):
    rows = documents(spark, sf_dir).where("source is not null").select("doc_id", "source", T.clean_text(F.col("text")).alias("t"))
    return selection.queue_singles(rows, "explanation", 50, 4, id_col="doc_id", source="source", text="t").select("doc_id", "source", "turn", "suitability")


@query(f"""WITH a AS (SELECT doc_id, source, {sql_clean("text")} AS t, doc_id // 20 AS i FROM documents WHERE source IS NOT NULL),
b AS (SELECT doc_id, source, i, length(t) AS n, {sql_fit("t", "lower(t)", "cross_concept")} AS fit FROM a),
c AS (SELECT x.doc_id, x.source, y.doc_id AS neighbour, y.fit AS suitability, row_number() OVER (PARTITION BY x.doc_id ORDER BY y.fit DESC, y.doc_id DESC) AS rn
FROM b x JOIN b y ON x.source = y.source AND abs(x.i - y.i) BETWEEN 1 AND 10 AND x.n + y.n <= 3000)
SELECT doc_id, source, neighbour, suitability FROM c WHERE rn = 1""")
def neighbour_pairs(spark, sf_dir):
    rows = documents(spark, sf_dir).where("source is not null").select("doc_id", "source", F.expr("doc_id div 20").alias("i"), T.clean_text(F.col("text")).alias("t"))
    return selection.neighbour_pairs(rows, "cross_concept", "doc_id", "source", "i", "t")


@query("""WITH r AS (SELECT doc_id, max(quality) AS q, max(toxic) AS x FROM labels GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN r.doc_id IS NULL THEN 'missing_judge_pass' ELSE array_to_string(list_filter([CASE WHEN q <> 1 THEN 'judge_not_faithful' END,
CASE WHEN x = 1 THEN 'judge_overclaim' END], lambda y: y IS NOT NULL), ',') END AS reasons,
CASE WHEN q = 1 AND x = 0 THEN 1.0::DOUBLE END AS quality_score FROM documents d LEFT JOIN r USING (doc_id)""")
def dual_consensus(spark, sf_dir):
    """Labels as two agreeing passes: quality as faithful, toxic as overclaim."""
    marks = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("q"), F.max("toxic").alias("x"))
    yes, no = F.lit(True), F.lit(False)
    flags = {f: yes for f in consensus.FLAGS} | {"contradiction": no, "faithful": F.col("q") == 1, "overclaim": F.col("x") == 1}
    five = F.struct(*(F.lit(5).alias(s) for s in consensus.SCORES))
    none = F.array().cast("array<string>")
    payload = F.struct(*(v.alias(k) for k, v in flags.items()), five.alias("scores"), F.lit("definition").alias("canonical_question_type"),
                       none.alias("unsupported_claims"), none.alias("reason_codes"), F.lit("").alias("reason")).cast(consensus.PAYLOAD)
    judged = marks.select("doc_id", F.lit(1).alias("line_no"), payload.alias("judge_result"))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.lit("train").alias("split"), F.lit(None).cast("string").alias("challenge_category"), F.lit(1.0).alias("answer_source_overlap"))
    found = consensus.build_consensus(rows, judged, judged, "doc_id")
    return found.select("doc_id", joined("reasons").alias("reasons"), "quality_score")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def resume_anti_join(spark, sf_dir):
    return consensus.pending(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


@query("""SELECT 'documents' AS relation, count(*)::BIGINT AS n FROM documents UNION ALL SELECT 'benchmark', count(*)::BIGINT FROM benchmark
UNION ALL SELECT 'labels', count(*)::BIGINT FROM labels UNION ALL SELECT 'conversations', count(*)::BIGINT FROM conversations""")
def status_counts(spark, sf_dir):
    return audit.status(**{n: table(spark, sf_dir, n) for n in ("documents", "benchmark", "labels", "conversations")})


@query("""SELECT (count(*) = count(DISTINCT doc_id))::INTEGER AS unique_ids, bool_and(text IS NOT NULL)::INTEGER AS texts_present,
(count(*) FILTER (WHERE source IS NULL) = 0)::INTEGER AS sources_present FROM documents""")
def audit_checks(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    checks = {
        "unique_ids": F.count("*") == F.countDistinct("doc_id"),
        "texts_present": F.bool_and(F.col("text").isNotNull()),
        "sources_present": F.count_if(F.col("source").isNull()) == 0,
    }
    return audit.checks(docs, checks)


@query("""SELECT lang, count(*)::BIGINT AS n, count(DISTINCT source)::BIGINT AS sources, round(avg(n_chars), 2) AS mean_chars, max(n_chars)::BIGINT AS most_chars,
round(avg(n_chars) / 3.5, 2) AS tokens_estimate FROM documents GROUP BY lang""")
def split_summary(spark, sf_dir):
    return audit.summary(table(spark, sf_dir, "documents"), "lang", "n_chars", "source")


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def payload_parse(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    return rows.select("event_id", F.get_json_object(T.json_payload(F.col("props")), "$.k").alias("k"))


@query(_PAIRS + "SELECT conv_id, turn, '<user>' || chr(10) || question || '<end>' || chr(10) || '<assistant>' || chr(10) || answer || '<end>' AS rendered FROM q")
def messages_struct(spark, sf_dir):
    rows = pairs(spark, sf_dir)
    messages = F.array(*(F.struct(F.lit(r).alias("role"), F.col(c).alias("content")) for r, c in (("user", "question"), ("assistant", "answer"))))
    return rows.select("conv_id", "turn", T.chat_text(messages).alias("rendered"))


@query("SELECT sha256(string_agg(item_id || ':' || text, chr(10) ORDER BY item_id)) AS seal, count(*)::BIGINT AS n FROM benchmark")
def artifact_seal(spark, sf_dir):
    return audit.seal(table(spark, sf_dir, "benchmark"), "item_id", F.concat(F.col("item_id").cast("string"), F.lit(":"), F.col("text")))


# --- passes over model texts, made from documents ----------------------------------------------------------------------


def generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A queue row for each document, with a model text that quotes it."""
    docs = table(spark, sf_dir, "documents").where("text is not null")
    context = F.struct(F.col("doc_id").cast("string").alias("paragraph_id"), F.col("source").alias("source_file"), F.lit(0).alias("paragraph_index"), "text")
    asked = F.concat(F.lit("What do the words "), F.substring("text", 1, 80), F.lit(" mean?"))
    told = F.concat(F.lit("They say that "), F.substring("text", 81, 400), F.lit("."))
    payload = F.to_json(F.struct(asked.alias("question"), told.alias("answer"), F.array(F.substring("text", 81, 120)).alias("evidence_quotes")))
    return docs.select(
        F.col("doc_id").cast("string").alias("candidate_id"), F.lit("train").alias("split"), F.lit(None).cast("string").alias("challenge_category"),
        F.array(context).alias("contexts"), F.col("text").alias("source_text"), F.lit(1.0).alias("evidence_quality_score"), F.lit("h").alias("config_hash"),
        payload.alias("raw_generation"),
    )


@query()
def hard_filter_reasons(spark, sf_dir):
    """The hard filter over a generation for each document, then membership of the queue."""
    rows = generations(spark, sf_dir)
    found = generation.membership_reasons(generation.hard_filter(rows), rows, "train", "h")
    spans = F.transform("evidence_spans", lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string")))
    return found.select("candidate_id", joined("reasons").alias("reasons"), "answer_source_overlap", "hard_quality_score", joined(spans).alias("spans"))


@query()
def training_generation_reasons(spark, sf_dir):
    """The training gate over a tagged text for each document."""
    docs = T.with_nfkc(table(spark, sf_dir, "documents").where("text is not null"), "text").select("doc_id", T.clean_text(F.col("text")).alias("t"))
    tag = lambda name, c: F.concat(F.lit(f"<{name}>"), c, F.lit(f"</{name}>"))
    asked = F.concat(F.lit("What do the words "), F.substring("t", 1, 80), F.lit(" mean?"))
    raw = F.concat(tag("question", asked), tag("answer", F.substring("t", 81, 400)), tag("evidence_quote", F.substring("t", 81, 120)))
    rows = docs.select("doc_id", "t", training.tagged_or_json(raw).alias("g"))
    why = training.generation_reasons(F.col("g.question"), F.col("g.answer"), F.col("t"), F.col("g.evidence_quote"))
    why = F.when(F.col("g").isNull(), F.array(F.lit("generation_parse_error"))).otherwise(why)
    return rows.select("doc_id", "g.question_type", joined(why).alias("reasons"))


@query()
def evaluation_candidates(spark, sf_dir):
    """Pairs through quality and provenance against the lines of documents."""
    asked = pairs(spark, sf_dir).withColumn("line_no", F.col("conv_id") * 100000 + F.col("turn"))
    lines = table(spark, sf_dir, "documents").select("doc_id", "source", F.posexplode(F.split("text", "\n", -1)).alias("pos", "text"))
    lines = lines.select("text", F.col("doc_id").cast("string").alias("source_file"), F.col("pos").alias("paragraph_index"), (F.col("doc_id") * 100000 + F.col("pos")).alias("line_no"))
    found = evaluation.candidates(asked, lines)
    return found.select("line_no", "qa_id", "question_type", "quality_score", "source_file", "provenance_score", "provenance_method", joined("reasons").alias("reasons"))


@query()
def queue_pairs(spark, sf_dir):
    """Up to 20 pairs of neighbouring documents of each source, no document in two."""
    rows = documents(spark, sf_dir).where("source is not null").select("doc_id", "source", F.expr("doc_id div 20").alias("i"), T.clean_text(F.col("text")).alias("t"))
    return selection.queue_pairs(rows, "cross_concept", 20, "doc_id", "source", "i", "t")


@query()
def legacy_paragraphs(spark, sf_dir):
    """Paragraphs of whole texts taken as files."""
    files = table(spark, sf_dir, "documents").where("text is not null").select(F.col("doc_id").alias("source_file"), F.col("text").alias("value"))
    return generation.file_paragraphs(files)


_PREDICTED = "SELECT conv_id, turn, list_distinct(regexp_extract_all(lower(answer), '[a-z0-9'']+')) AS p, list_distinct(regexp_extract_all(lower(question), '[a-z0-9'']+')) AS r FROM q"


@query(_PAIRS + f"SELECT conv_id, turn, round(len(list_intersect(p, r)) / greatest(1, len(p))::DOUBLE, 4) AS overlap FROM ({_PREDICTED})")
def prediction_overlap(spark, sf_dir):
    """Share of an answer's distinct tokens that its question has."""
    rows = pairs(spark, sf_dir).select("conv_id", "turn", T.evaluation_tokens(F.col("answer")).alias("p"), T.evaluation_tokens(F.col("question")).alias("r"))
    share = F.size(F.array_intersect("p", "r")) / F.greatest(F.size("p"), F.lit(1))
    return rows.select("conv_id", "turn", F.round(share, 4).alias("overlap"))


@query("""WITH q AS (SELECT lang, source, count(*) AS n FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL GROUP BY ALL),
w AS (SELECT lang, source, greatest(0, 5 - n) AS short FROM q) SELECT lang, sum(short)::BIGINT AS missing FROM w GROUP BY lang""")
def source_shortfalls(spark, sf_dir):
    """By language, what its sources lack of a floor of five documents."""
    rows = table(spark, sf_dir, "documents").where("lang is not null and source is not null").groupBy("lang", "source").agg(F.count("*").alias("n"))
    return rows.groupBy("lang").agg(F.sum(F.greatest(F.lit(0), 5 - F.col("n"))).cast("bigint").alias("missing"))


from corpusloom import catalogue_more  # noqa: E402, F401  (registers its queries)
