"""Queries of the X and Q families, and P19."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import asof, quality, text
from .demo import participations, query, snapshots, table, with_pt, with_snap
from .windows import asof_rate, history

RULES = [("(?i)the ", "article"), ("(?i)ion", "noun"), ("[0-9]", "number"), ("(?i)and ", "link"), ("(?i)der|die", "german")]
SENT = """st AS (SELECT doc_id AS id, pos, sentence FROM (SELECT doc_id, generate_subscripts(p, 1) - 1 AS pos, trim(unnest(p), ' ') AS sentence FROM (SELECT doc_id, string_split_regex(coalesce(text, ''), '[.\\n]') AS p FROM documents)) WHERE sentence <> '')"""


@query("X1_tags", f"WITH {SENT} SELECT tags, count(*) AS n FROM (SELECT array_to_string(list_sort(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(sentence, '{p}') THEN '{t}' END" for p, t in RULES) + "], lambda x: x IS NOT NULL)), ',') AS tags FROM st) GROUP BY 1")
def tags(spark, d):
    s = text.sentences(table(spark, d, "documents"), "doc_id", "text")
    return s.groupBy(F.array_join(text.tags_of(F.col("sentence"), RULES), ",").alias("tags")).agg(F.count("*").alias("n"))


#: Boiler-plate is skipped; of two labels that contradict each other none is kept.
SKIP, EXCLUSIVE = "(?i)licen[sc]e|copyright|rights reserved|cookie", [("article", "german")]
X1 = f"""ob AS (SELECT id, regexp_matches(sentence, '{SKIP}') AS boiler, {", ".join(f"regexp_matches(sentence, '{p}') AS t_{t}" for p, t in RULES)} FROM st),
 og AS (SELECT id, {", ".join(f"bool_or(t_{t} AND NOT boiler) AS t_{t}" for _, t in RULES)}, count(*) FILTER (WHERE NOT (boiler OR {" OR ".join(f"t_{t}" for _, t in RULES)})) AS unmatched, count(*) FILTER (WHERE boiler) AS skipped FROM ob GROUP BY 1)"""


@query("X1_tag_report", f"WITH {SENT}, {X1} SELECT id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN t_{t}{' AND NOT (t_article AND t_german)' if t in EXCLUSIVE[0] else ''} THEN '{t}' END" for t in sorted(t for _, t in RULES)) + "], lambda x: x IS NOT NULL), ',') AS tags, unmatched, skipped FROM og")
def tag_report(spark, d):
    """Tags of each text, its sentences that no rule matches, and those skipped as boiler-plate."""
    r = text.tag_report(text.sentences(table(spark, d, "documents"), "doc_id", "text"), RULES, SKIP, EXCLUSIVE)
    return r.withColumn("tags", F.array_join("tags", ","))


@query("X2_negation", f"WITH {SENT} SELECT id, count(*) AS n FROM st WHERE regexp_matches(replace(sentence, 'the of', ''), '\\bthe\\b') GROUP BY 1")
def negation(spark, d):
    s = text.sentences(table(spark, d, "documents"), "doc_id", "text")
    return s.filter(text.affirmed(F.col("sentence"), r"\bthe\b", " of")).groupBy("id").agg(F.count("*").alias("n"))


#: Groups by the words that name them; "word" is the generic one. Fixed values.
GROUPS = {"article": "the|la", "link": "and|que", "word": "the|of|de|en|is"}
TAIL, NOTICE, DATE = "of|in|may|not", "^(?:Is|It|En) ", "[0-9]{2,9}"
#: Ends of words; runs of word characters and of others, for the SQL.
_L, _R = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"


def _affirmed_sql(words: str) -> str:
    """The SQL has no lookahead: runs of word characters and runs between them in order, a word without a tail one blank behind it."""
    listed = lambda s: ", ".join(f"'{w}'" for w in s.split("|"))
    tail = f"coalesce(runs[i + 1] = ' ' AND runs[i + 2] IN ({listed(TAIL)}), false)"
    return f"len(list_filter(range(1, len(runs) + 1), lambda i: runs[i] IN ({listed(words)}) AND NOT {tail})) > 0"


_RUNS = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+"
_GRP = ", ".join(f"CASE WHEN {_affirmed_sql(p)} THEN '{g}' END" for g, p in GROUPS.items())
X2 = f"""fd AS (SELECT id, pos, sentence, list_filter([{_GRP}], lambda x: x IS NOT NULL) AS f, nullif(regexp_extract(sentence, '{DATE}'), '')::BIGINT AS dated FROM (SELECT *, regexp_extract_all(sentence, '{_RUNS}') AS runs FROM st) WHERE NOT regexp_matches(sentence, '{NOTICE}')),
 fg AS (SELECT id, pos, sentence, dated, unnest(CASE WHEN len(f) > 1 THEN list_filter(f, lambda x: x <> 'word') ELSE f END) AS grp FROM fd),
 fn AS (SELECT id, pos, sentence, grp, coalesce(dated, max(dated) OVER (PARTITION BY id, grp)) AS dated FROM fg)"""


@query("X2_events", f"WITH {SENT}, {X2} SELECT id, grp, dated, count(*) AS n, md5(string_agg(sentence, ' ' ORDER BY pos)) AS text_md5 FROM fn GROUP BY 1, 2, 3")
def tag_events(spark, d):
    """Affirmed groups of words by text and date (its first number), sentences joined in their order."""
    s = text.sentences(table(spark, d, "documents"), "doc_id", "text")
    e = text.tag_events(s, {g: f"{_L}(?:{w}){_R}" for g, w in GROUPS.items()}, f" (?:{TAIL}){_R}", NOTICE, DATE, "word")
    return e.select("id", "grp", F.col("at").alias("dated"), "n", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query("X3_blocks", "SELECT conv_id, block, count(*) AS lines, min(turn) AS first FROM (SELECT *, sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT AS block FROM conversations) GROUP BY 1, 2")
def blocks(spark, d):
    lines = text.blocks(table(spark, d, "conversations"), ["conv_id"], ["turn"], F.col("role") == "user")
    return lines.groupBy("conv_id", "block").agg(F.count("*").alias("lines"), F.min("turn").alias("first"))


#: Lines of a report: which go on with the line before, which start and stop a block, kinds in order, words for causes.
GOES_ON, START, STOP = r"^(?:[a-z0-9(]|[^A-Z]{0,9}$)", r"^(?:The|To|As|Th|De|La|Der)", r"^(?:In|Is|It|On|En|Die)"
KINDS, CAUSES = [("(?:tion|ción)", "action"), ("(?:ing|ung)", "state"), ("[0-9]", "number"), (".", "other")], ["the", "then", "that", "than", "de", "der", "des"]
X3 = f"""ln AS (SELECT doc_id AS id, pos, line FROM (SELECT doc_id, generate_subscripts(p, 1) - 1 AS pos, trim(unnest(p), ' ') AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents)) WHERE line <> ''),
 un AS (SELECT id, unit, min(pos) AS pos, string_agg(line, ' ' ORDER BY pos) AS line FROM (SELECT *, sum((NOT regexp_matches(line, '{GOES_ON}'))::INT) OVER (PARTITION BY id ORDER BY pos) AS unit FROM ln) GROUP BY 1, 2),
 bk AS (SELECT *, sum(regexp_matches(line, '{START}')::INT) OVER (PARTITION BY id ORDER BY pos)::BIGINT AS block FROM un),
 ev AS (SELECT * FROM (SELECT *, sum(regexp_matches(line, '{STOP}')::INT) OVER (PARTITION BY id, block ORDER BY pos) AS stops FROM bk WHERE block > 0) WHERE stops = 0)"""


@query("X3_report_events", f"WITH {X3} SELECT id, block, pos::INT AS pos, CASE " + " ".join(f"WHEN regexp_matches(line, '{p}') THEN '{k}' END".replace(" END", "") for p, k in KINDS) + f" END AS kind, nullif(regexp_extract(line, '({'|'.join(sorted(CAUSES, key=lambda w: (-len(w), w)))})', 1), '') AS cause, length(line) AS chars FROM ev")
def report_events(spark, d):
    """Events of reports, a text each: lines joined over page breaks, blocks between start and stop lines, kind and cause."""
    parts = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda s: F.btrim(s))
    lines = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.posexplode(parts).alias("pos", "line")).filter("line <> ''")
    e = text.report_events(text.report_lines(lines, ["id"], "pos", "line", GOES_ON), ["id"], "pos", "line", START, STOP, KINDS, CAUSES)
    return e.select("id", "block", "pos", "kind", "cause", F.char_length("line").cast("long").alias("chars"))


ALONE = "^(?:From|Until|On) [0-9]"
#: Reports made of orders: brackets with full stops, tails, periods of each form, some of them sentences on their own.
RP = r"""rp AS (SELECT o_orderkey AS id, a, 'Case ' || k || ' of ' || o_orderpriority || ' (rule ' || k % 7 || '. of ' || k % 5 || '.) is ' || CASE k % 4 WHEN 0 THEN 'out from ' || a || ' to ' || b WHEN 1 THEN 'out until ' || b WHEN 2 THEN 'out on ' || a || ', ' || c || ' and ' || b ELSE 'warned' END
   || '. (noted ' || k % 3 || '.) ' || CASE k % 3 WHEN 0 THEN 'From ' || c || ' to ' || a WHEN 1 THEN 'Until ' || b ELSE 'It goes on' END || '. Others ran (' || k % 2 || '. and more).' AS t FROM (SELECT *, o_orderkey AS k, dayofyear(o_orderdate) AS a, dayofyear(o_orderdate) + o_orderkey % 11 AS b, dayofyear(o_orderdate) + o_orderkey % 5 AS c FROM orders))"""
X3_SENTENCES = rf"""{RP}, p0 AS (SELECT id, generate_subscripts(p, 1) - 1 AS pos, unnest(p) AS s, len(p) - 1 AS stop FROM (SELECT id, string_split(t, '.') AS p FROM rp)),
 p1 AS (SELECT *, sum((length(s) - length(replace(s, '(', ''))) - (length(s) - length(replace(s, ')', '')))) OVER w AS run FROM p0 WINDOW w AS (PARTITION BY id ORDER BY pos)), p2 AS (SELECT *, run - least(0, min(run) OVER w) AS depth FROM p1 WINDOW w AS (PARTITION BY id ORDER BY pos)),
 p3 AS (SELECT *, coalesce(lag(depth) OVER w, 0) > 0 AS inside FROM p2 WINDOW w AS (PARTITION BY id ORDER BY pos)), p4 AS (SELECT *, sum((NOT inside)::INT) OVER (PARTITION BY id ORDER BY pos) AS unit FROM p3),
 u0 AS (SELECT id, unit, trim(string_agg(s, '.' ORDER BY pos) || CASE WHEN max(pos) < any_value(stop) THEN '.' ELSE '' END) AS s FROM p4 GROUP BY 1, 2), u1 AS (SELECT *, regexp_extract(s, '^(\([^)]*\)\.?)', 1) AS tail FROM u0 WHERE s NOT IN ('', '.')),
 u2 AS (SELECT id, unit, 0 AS k, tail AS s, true AS back FROM u1 UNION ALL SELECT id, unit, 1, trim(substr(s, length(tail) + 1)), regexp_matches(trim(substr(s, length(tail) + 1)), '{ALONE}') FROM u1), u3 AS (SELECT *, row_number() OVER w AS place, lag(unit) OVER w AS pu FROM u2 WHERE s NOT IN ('', '.') WINDOW w AS (PARTITION BY id ORDER BY unit, k)),
 u4 AS (SELECT *, sum((NOT (place > 1 AND (back OR (place = 2 AND k = 1 AND pu = unit))))::INT) OVER (PARTITION BY id ORDER BY unit, k) AS no FROM u3), sn AS (SELECT id, no::BIGINT AS unit, string_agg(s, ' ' ORDER BY u4.unit, k) AS s FROM u4 GROUP BY id, no),
 fm AS (SELECT sn.*, a, CASE WHEN regexp_matches(s, '\b[Ff]rom [0-9]+ to [0-9]+') THEN 'range' WHEN regexp_matches(s, '\b[Uu]ntil [0-9]+') THEN 'until' WHEN regexp_matches(s, '\b[Oo]n [0-9]+') THEN 'list' END AS form FROM sn JOIN rp USING (id)),
 dy AS (SELECT *, CASE form WHEN 'range' THEN [[regexp_extract(s, '\b[Ff]rom ([0-9]+) to', 1)::BIGINT, regexp_extract(s, '\b[Ff]rom [0-9]+ to ([0-9]+)', 1)::BIGINT]] WHEN 'until' THEN [[a, regexp_extract(s, '\b[Uu]ntil ([0-9]+)', 1)::BIGINT]] WHEN 'list' THEN [[x::BIGINT, x::BIGINT] FOR x IN list_distinct(regexp_extract_all(regexp_extract(s, '\b[Oo]n ([0-9]+(?:, [0-9]+)*(?: and [0-9]+)?)', 1), '[0-9]+'))] ELSE [] END AS days FROM fm)"""


@query("X3_periods", f"WITH {X3_SENTENCES} SELECT id, unit, md5(s) AS sentence_md5, form, coalesce(list_sum([x[2] - x[1] + 1 FOR x IN days IF x[1] <= x[2]]), 0)::BIGINT AS days, list_min([x[1] FOR x IN days IF x[1] <= x[2]]) AS first FROM dy")
def report_periods(spark, d):
    """Sentences of reports made of orders, with brackets and lone periods where they belong, and the days each names."""
    k, pri = F.col("o_orderkey"), F.col("o_orderpriority")
    a = F.dayofyear("o_orderdate").cast("long")
    b, c = a + k % 11, a + k % 5
    form = F.when(k % 4 == 0, F.concat(F.lit("out from "), a, F.lit(" to "), b)).when(k % 4 == 1, F.concat(F.lit("out until "), b)).when(k % 4 == 2, F.concat(F.lit("out on "), a, F.lit(", "), c, F.lit(" and "), b)).otherwise("warned")
    more = F.when(k % 3 == 0, F.concat(F.lit("From "), c, F.lit(" to "), a)).when(k % 3 == 1, F.concat(F.lit("Until "), b)).otherwise("It goes on")
    t = F.concat(F.lit("Case "), k, F.lit(" of "), pri, F.lit(" (rule "), k % 7, F.lit(". of "), k % 5, F.lit(".) is "), form, F.lit(". (noted "), k % 3, F.lit(".) "), more, F.lit(". Others ran ("), k % 2, F.lit(". and more)."))
    reports = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), a.alias("a"), t.alias("t"))
    s = text.report_sentences(reports, ["id", "a"], "t", ALONE)
    kind, days = text.periods(F.col("sentence"), F.col("a"))
    s = s.select("id", "unit", F.md5(F.col("sentence").cast("binary")).alias("sentence_md5"), kind.alias("form"), days.alias("d"))
    return s.select("id", "unit", "sentence_md5", "form", F.aggregate("d", F.lit(0).cast("long"), lambda n, x: n + x["last"] - x["first"] + 1).alias("days"), F.array_min(F.transform("d", lambda x: x["first"])).alias("first"))


@query("X4_templates", f"WITH {SENT} SELECT md5(regexp_replace(regexp_replace(sentence, '[A-Z][a-z]+', 'N', 'g'), '[0-9]+', '0', 'g')) AS key, count(*) AS n, min(id) AS first FROM st GROUP BY 1 HAVING count(*) >= 3")
def templates(spark, d):
    s = text.sentences(table(spark, d, "documents"), "doc_id", "text")
    key = F.md5(text.template(F.col("sentence"), [("[A-Z][a-z]+", "N"), ("[0-9]+", "0")]).cast("binary"))
    return s.groupBy(key.alias("key")).agg(F.count("*").alias("n"), F.min("id").alias("first")).filter("n >= 3")


MASKS = [("[A-Z][a-z]+", "N"), ("[0-9]+", "0"), ("(?:tion|ing|ed|en|er)", "~")]
_MASKED = "md5(regexp_replace(regexp_replace(regexp_replace({0}, '[A-Z][a-z]+', 'N', 'g'), '[0-9]+', '0', 'g'), '(?:tion|ing|ed|en|er)', '~', 'g'))"
_BENCH = SENT.replace("st AS", "sb AS").replace("doc_id", "item_id").replace("documents", "benchmark")
X4 = f"kt AS (SELECT {_MASKED.format('sentence')} AS key, count(*) AS n FROM st GROUP BY 1), lb AS (SELECT {_MASKED.format('sentence')} AS key, 'item ' || min(id) AS label FROM sb GROUP BY 1), kl AS (SELECT key, n, label FROM kt LEFT JOIN lb USING (key))"


@query("X4_dictionary", f"WITH {SENT}, {_BENCH}, {X4} SELECT label, NULL::VARCHAR AS key, sum(n)::BIGINT AS n FROM kl WHERE label IS NOT NULL GROUP BY 1 UNION ALL (SELECT label, key, n FROM kl WHERE label IS NULL ORDER BY n DESC, key LIMIT 20)")
def template_labels(spark, d):
    """Sentences by their template's label (templates of benchmark items), and the 20 most frequent templates without one."""
    sentences = lambda name, i: text.sentences(table(spark, d, name), i, "text").withColumn("key", F.md5(text.template(F.col("sentence"), MASKS).cast("binary")))
    labels = sentences("benchmark", "item_id").groupBy("key").agg(F.concat(F.lit("item "), F.min("id").cast("string")).alias("label"))
    return text.label_templates(sentences("documents", "doc_id").groupBy("key").agg(F.count("*").alias("n")), labels, 20)


@query("X5_dictionary", "WITH x AS (SELECT l_orderkey AS o, l_linenumber AS l, CASE WHEN l_partkey % 97 <> 0 THEN l_partkey END AS v FROM lineitem), c AS (SELECT v, row_number() OVER (ORDER BY min((o, l)), v) - 1 AS code FROM x WHERE v IS NOT NULL GROUP BY 1) SELECT x.v, coalesce(code, -1)::BIGINT AS code, count(*) AS n FROM x LEFT JOIN c USING (v) GROUP BY 1, 2")
def dictionary(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("l"), F.when(F.col("l_partkey") % 97 != 0, F.col("l_partkey")).alias("v"))
    return text.dictionary_codes(li, "v", ["o", "l"]).groupBy("v", "code").agg(F.count("*").alias("n"))


@query("X6_repeats", "SELECT status, cust, run, min(dd) AS since, max(dd) AS until, count(*) AS n FROM (SELECT *, sum(f) OVER (PARTITION BY status, cust ORDER BY dd, id)::BIGINT AS run FROM (SELECT *, CASE WHEN dd - lag(dd) OVER (PARTITION BY status, cust ORDER BY dd, id) <= 7 THEN 0 ELSE 1 END AS f FROM (SELECT o_orderkey AS id, o_orderstatus AS status, o_custkey AS cust, date_diff('day', DATE '2000-01-01', o_orderdate::DATE)::INT AS dd FROM orders))) GROUP BY 1, 2, 3")
def repeats(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("cust"), F.datediff(F.col("o_orderdate").cast("date"), F.lit("2000-01-01").cast("date")).alias("dd"))
    return text.merge_repeats(o, ["status", "cust"], "dd", 7, ["id"])


@query("X7_page_tables", r"""SELECT page_id, pos, cell[1] AS target, cell[2] AS label, length(cell[2]) AS chars FROM (SELECT page_id, generate_subscripts(t, 1) - 1 AS pos, [unnest(t), unnest(l)] AS cell FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"<]*)">([^<]*)</a>', 1) AS t, regexp_extract_all(html, '<a href="([^"<]*)">([^<]*)</a>', 2) AS l FROM pages))""")
def page_tables(spark, d):
    """Typed rows out of pages: each row of the navigation list with its place, target and label; no parser library."""
    cell = F.lit('<a href="([^"<]*)">([^<]*)</a>')
    pages = table(spark, d, "pages").select("page_id", F.regexp_extract_all("html", cell, F.lit(1)).alias("t"), F.regexp_extract_all("html", cell, F.lit(2)).alias("l"))
    rows = pages.select("page_id", F.posexplode(F.arrays_zip("t", "l")).alias("pos", "cell"))
    return rows.select("page_id", "pos", F.col("cell.t").alias("target"), F.col("cell.l").alias("label"), F.char_length("cell.l").alias("chars"))


_WORDS = "SELECT DISTINCT {0}, unnest(string_split_regex(lower(text), '[^\\p{{L}}]+')) AS w FROM {1}"


@query("X8_linked_reports", f"SELECT doc_id, count(*) AS n, min(item) AS first_item FROM ({_WORDS.format('doc_id', 'documents')}) JOIN (SELECT w, min(item_id) AS item FROM ({_WORDS.format('item_id', 'benchmark')}) GROUP BY 1) USING (w) WHERE w <> '' GROUP BY 1")
def linked_reports(spark, d):
    """Documents and the roster words (those of benchmark items) in them, with the first item that has one."""
    words = lambda df, i: df.select(F.col(i), F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("w")).filter("w <> ''")
    roster = words(table(spark, d, "benchmark"), "item_id").groupBy("w").agg(F.min("item_id").alias("item"))
    return words(table(spark, d, "documents"), "doc_id").join(roster, "w").groupBy("doc_id").agg(F.count("*").alias("n"), F.min("item").alias("first_item"))


@query("P19_normal_keys", "SELECT s_suppkey AS id, lower(regexp_replace(trim(s_name), '\\s+', ' ', 'g')) AS key FROM supplier")
def normal_keys(spark, d):
    """NFKC and white-space keys: Arrow batches for texts beyond ASCII, plain expressions for the others."""
    @F.pandas_udf("string")
    def nfkc(s):
        return s.str.normalize("NFKC")

    name = F.col("s_name")
    plain = F.octet_length(name) == F.char_length(name)
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), name)
    rest = s.filter(~F.coalesce(plain, F.lit(True))).select("id", nfkc("s_name").alias("s_name"))
    both = s.filter(F.coalesce(plain, F.lit(True))).unionByName(rest)
    return both.select("id", F.lower(F.regexp_replace(F.btrim("s_name"), r"\s+", " ")).alias("key"))


def line_rules():
    return {
        "quantity": F.col("l_quantity").between(1, 45), "discount": F.col("l_discount") <= 0.09, "flag": F.col("l_returnflag").isin("A", "N", "R"),
        "price": F.col("l_extendedprice") > 0,
    }


LINE = "l_quantity BETWEEN 1 AND 45", "l_discount <= 0.09", "l_returnflag IN ('A', 'N', 'R')", "l_extendedprice > 0"


@query("Q1_quarantine", "SELECT reasons, count(*) AS n FROM (SELECT array_to_string(list_filter([" + ", ".join(f"CASE WHEN NOT ({r}) THEN '{n}' END" for r, n in zip(LINE, ("quantity", "discount", "flag", "price"), strict=True)) + "], lambda x: x IS NOT NULL), ',') AS reasons FROM lineitem) WHERE reasons <> '' GROUP BY 1")
def q1(spark, d):
    _, bad = quality.quarantine(table(spark, d, "lineitem"), line_rules(), most=0.9)
    return bad.groupBy(F.array_join("reasons", ",").alias("reasons")).agg(F.count("*").alias("n"))


@query("Q2_constraints", " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) FILTER (WHERE NOT ({r})) AS n FROM lineitem" for r, n in zip(LINE, ("quantity", "discount", "flag", "price"), strict=True)) + " UNION ALL SELECT 'unique', (count(*) - count(DISTINCT (l_orderkey, l_linenumber)))::BIGINT FROM lineitem")
def q2(spark, d):
    return quality.violations(table(spark, d, "lineitem"), line_rules(), {"unique": ["l_orderkey", "l_linenumber"]})


@query("Q3_recount", with_pt("SELECT entity, d_idx, n, r AS recount FROM (SELECT h.*, (SELECT count(*) FROM pt q WHERE q.entity = h.entity AND q.d_idx BETWEEN h.d_idx - 365 AND h.d_idx - 1) AS r FROM (SELECT entity, d_idx, coalesce(sum(n) OVER (PARTITION BY entity ORDER BY d_idx RANGE BETWEEN 365 PRECEDING AND 1 PRECEDING), 0)::BIGINT AS n FROM (SELECT entity, d_idx, count(*) AS n FROM pt GROUP BY 1, 2)) h ORDER BY md5(entity || ':' || d_idx), entity, d_idx LIMIT 300)"))
def q3(spark, d):
    """300 hash-ordered rows (the sample is the operator) recounted by an independent band join."""
    p = participations(spark, d)
    w = asof.window_sums(history(p), ["entity"], "d_idx", ["n"], 365)
    pick = w.orderBy(F.md5(F.concat_ws(":", "entity", "d_idx").cast("binary")), "entity", "d_idx").limit(300)
    pick = pick.select("entity", "d_idx", F.coalesce("n_before", F.lit(0)).cast("long").alias("n"))
    near = asof.band_join(pick, p.select("entity", F.col("d_idx").alias("at")), by=["entity"], left_on="d_idx", right_on="at", days=365)
    again = near.groupBy("entity", "d_idx").agg(F.count("*").alias("recount"))
    return pick.join(again, ["entity", "d_idx"], "left").withColumn("recount", F.coalesce("recount", F.lit(0)).cast("long"))


@query("Q4_leakage", "SELECT 0::BIGINT AS leaks")
def q4(spark, d):
    def build(rows):
        w = asof.window_sums(history(rows), ["entity"], "d_idx", ["n", "hits"], 365)
        return w.select("entity", "d_idx", "n_before", "hits_before")

    return quality.leak_rows(build, participations(spark, d), "d_idx", -700, ["entity", "d_idx"]).agg(F.count("*").alias("leaks"))


@query("Q5_rise_guard", with_snap("SELECT count(*) FILTER (WHERE a.price IS NOT NULL AND b.price > a.price * 1.5) AS rises, count(*) FILTER (WHERE b.price > 500000) AS beyond, count(*) FILTER (WHERE b.price IS NULL) AS lost FROM sb b LEFT JOIN sa a USING (id)"))
def q5(spark, d):
    a, b = snapshots(spark, d)
    j = b.join(a.select("id", F.col("price").alias("was")), "id", "left")
    return j.agg(F.count_if(F.col("price") > F.col("was") * 1.5).alias("rises"), F.count_if(F.col("price") > 500000).alias("beyond"), F.count_if(F.col("price").isNull()).alias("lost"))


@query("Q6_drift_guard", "SELECT yr, n, n < 0.9 * lag(n) OVER (ORDER BY yr) AS drop FROM (SELECT year(o_orderdate)::INT AS yr, count(*) AS n FROM orders GROUP BY 1)".replace(" AS drop FROM", " AS shrunk FROM"))
def q6(spark, d):
    y = table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("yr")).agg(F.count("*").alias("n"))
    return y.select("yr", "n", (F.col("n") < 0.9 * F.lag("n").over(Window.orderBy("yr"))).alias("shrunk"))  # one row a year


@query("Q6_refused_writes", with_snap("SELECT id, price, status, day, replaced FROM (SELECT *, false AS replaced FROM sa UNION ALL SELECT *, true FROM sb) JOIN (SELECT month(a.day) AS mo, b.n >= 1.33 * a.n AS ok FROM (SELECT any_value(day) AS day, count(*) AS n FROM sa GROUP BY month(day)) a JOIN (SELECT month(day) AS mo, count(*) AS n FROM sb GROUP BY 1) b ON b.mo = month(a.day)) ON mo = month(day) WHERE replaced = ok"))
def refused_writes(spark, d):
    """A snapshot replaces the last one by month of its rows, unless it has too few of them."""
    old, new = (s.withColumn("mo", F.month("day")) for s in snapshots(spark, d))
    return quality.guarded_replace(old, new, "mo", 1.33).drop("mo")


FILLS = (30, 90, 365)
_FILL = "SELECT 'rate_{0}' AS feature, count(*) AS rows_n, round(count(rate) / count(*), 6) AS fill, count(*) FILTER (WHERE rate IS NULL) AS missing, count(rate) / count(*) < 0.5 AS degraded FROM (SELECT p.event, b.hb / nullif(b.nb, 0) AS rate FROM pt p JOIN (SELECT entity, d_idx, sum(n) OVER w AS nb, sum(h) OVER w AS hb FROM fb WINDOW w AS (PARTITION BY entity ORDER BY d_idx RANGE BETWEEN {0} PRECEDING AND 1 PRECEDING)) b USING (entity, d_idx))"


@query("Q7_fill_report", with_pt(" UNION ALL ".join(_FILL.format(k) for k in FILLS), "fb AS (SELECT entity, d_idx, count(*) AS n, count(*) FILTER (WHERE finish <= 3) AS h FROM pt GROUP BY 1, 2)"))
def q7(spark, d):
    """Fill of each feature column before scoring, those under a half marked as degraded; one pass over the rows."""
    p = participations(spark, d)
    days = history(p)
    for k in FILLS:
        w = asof.window_sums(days, ["entity"], "d_idx", ["n", "hits"], k)
        days = w.select(*days.columns, asof.rate(F.col("hits_before"), F.col("n_before")).alias(f"rate_{k}"))
    rows = p.select("entity", "d_idx").join(days, ["entity", "d_idx"])
    counts = rows.agg(F.count("*").alias("rows_n"), *[F.count(f"rate_{k}").alias(f"c{k}") for k in FILLS])
    fill = lambda k: F.col(f"c{k}") / F.col("rows_n")
    made = [F.struct(F.lit(f"rate_{k}").alias("feature"), F.col("rows_n"), F.round(fill(k), 6).alias("fill"), (F.col("rows_n") - F.col(f"c{k}")).alias("missing"), (fill(k) < 0.5).alias("degraded")) for k in FILLS]
    return counts.select(F.inline(F.array(*made)))


@query("Q8_agreement", with_snap("SELECT 'price' AS col, count(*) FILTER (WHERE a.price IS NOT NULL AND b.price IS NOT NULL) AS both, count(*) FILTER (WHERE a.price = b.price) AS same, count(*) FILTER (WHERE a.price IS NOT NULL AND b.price IS NULL) AS only_a, count(*) FILTER (WHERE a.price IS NULL AND b.price IS NOT NULL) AS only_b FROM sa a FULL JOIN sb b USING (id)").replace(" AS both,", ' AS "both",'))
def q8(spark, d):
    a, b = snapshots(spark, d)
    return quality.agreement(a, b, ["id"], ["price"])
