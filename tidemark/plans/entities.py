"""Queries of the N and R families."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import daily, form, graph, matching, ratings, stats
from ..operators import mentions as mention
from ..operators.asof import band_join
from ..sources import io
from .demo import OH, PT, hu, order_history, participations, query, snapshots, table, with_pt, with_snap
from .joins import PAIRS, pairs


@query("N1_entity_key", "SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN c_name || '|' || (DATE '1980-01-01' + (c_custkey % 900)::INT) WHEN c_custkey % 3 = 0 THEN c_name || '|' || (1980 + c_custkey % 20) END AS key FROM customer")
def entity_key(spark, d):
    c = table(spark, d, "customer")
    born = F.when(F.col("c_custkey") % 2 == 0, F.date_add(F.lit("1980-01-01").cast("date"), (F.col("c_custkey") % 900).cast("int")))
    year = F.when(F.col("c_custkey") % 3 == 0, 1980 + F.col("c_custkey") % 20)
    key = F.when(born.isNotNull(), F.concat_ws("|", "c_name", born.cast("string"))).when(year.isNotNull(), F.concat_ws("|", "c_name", year.cast("string")))
    return c.select(F.col("c_custkey").alias("id"), key.alias("key"))


@query("N2_homonyms", with_pt("SELECT name, count(*) AS n FROM life a WHERE EXISTS (SELECT 1 FROM life b WHERE a.name = b.name AND (a.ended < b.born OR b.ended < a.born)) GROUP BY 1", "life AS (SELECT entity * 100000 + rider AS id, sire AS name, min(d_idx) AS born, max(d_idx) AS ended FROM pt GROUP BY 1, 2)"))
def homonyms(spark, d):
    """Entities of a name with a namesake whose life doesn't overlap theirs: the group's extremes tell, no pairs needed."""
    w = Window.partitionBy("name")
    pair = (F.col("entity") * 100000 + F.col("rider")).alias("id")
    a = participations(spark, d).groupBy(pair, F.col("sire").alias("name")).agg(F.min("d_idx").alias("born"), F.max("d_idx").alias("ended"))
    a = a.withColumn("last_born", F.max("born").over(w)).withColumn("first_end", F.min("ended").over(w))
    return a.filter("last_born > ended OR first_end < born").groupBy("name").agg(F.count("*").alias("n"))


@query("N3_aliases", "SELECT key, min(id) AS canonical, count(*) AS n FROM (SELECT p_partkey AS id, lower(regexp_replace(p_type, '(PLATED|POLISHED|BRUSHED|ANODIZED|BURNISHED)\\s*', '', 'g')) || '|' || p_brand AS key FROM part) GROUP BY 1")
def aliases(spark, d):
    key = F.concat_ws("|", F.lower(F.regexp_replace("p_type", r"(PLATED|POLISHED|BRUSHED|ANODIZED|BURNISHED)\s*", "")), "p_brand")
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), key.alias("key")).groupBy("key").agg(F.min("id").alias("canonical"), F.count("*").alias("n"))


#: Abbreviations with their full forms, forms left out of the loosest key, and names joined by hand. Fixed values.
SHORT, FORMS, MANUAL = {"std": "standard", "promo": "promotional"}, ("plated", "polished", "brushed"), {"economybrand#11": "economybrand#12"}
_RAW = "CASE p_partkey % 5 WHEN 0 THEN upper(name) WHEN 1 THEN replace(name, ' ', '  ') WHEN 2 THEN replace(replace(name, 'STANDARD', 'STD'), 'PROMOTIONAL', 'PROMO') WHEN 3 THEN replace(name, ' PLATED', '') ELSE left(name, 18) END"
_L1 = r"lower(regexp_replace(raw, '\s+', '', 'g'))"
_LA = f"regexp_replace(regexp_replace({_L1}, '^std', 'standard'), '^promo', 'promotional')"
N3 = f"""nr AS (SELECT raw, count(*) AS n, max(id) AS newest FROM (SELECT p_partkey AS id, {_RAW} AS raw FROM (SELECT *, p_type || ' ' || p_brand || ' PLATED' AS name FROM part)) GROUP BY 1),
 nk AS (SELECT *, {_L1} AS l1, CASE WHEN {_L1} LIKE 'promotional%' THEN {_L1} ELSE {_LA} END AS la FROM nr),
 nb AS (SELECT *, replace(replace(replace(la, 'plated', ''), 'polished', ''), 'brushed', '') AS b0 FROM nk), nm AS (SELECT *, CASE b0 WHEN 'economybrand#11' THEN 'economybrand#12' ELSE b0 END AS kb FROM nb),
 cut AS (SELECT c.raw, min(f.kb) AS full_kb FROM nm c JOIN nm f ON left(f.la, 10) = left(c.la, 10) AND length(f.la) > length(c.la) AND starts_with(f.la, c.la) WHERE length(c.raw) = 18 GROUP BY 1 HAVING count(DISTINCT f.la) = 1),
 cl AS (SELECT nm.*, coalesce(full_kb, kb) AS cluster FROM nm LEFT JOIN cut USING (raw)),
 cc AS (SELECT cluster, arg_max(raw, (n, newest)) AS canonical, count(*) AS names, arg_max(l1, (n, newest)) AS c1, arg_max(la, (n, newest)) AS ca FROM cl GROUP BY 1)"""


@query("N3_alias_ladder", f"WITH {N3} SELECT raw, canonical, names, raw <> canonical AS redirected, CASE WHEN raw = canonical THEN 'own' WHEN l1 = c1 THEN 'L1' WHEN la = ca THEN 'A' WHEN kb <> cluster THEN 'cut' WHEN b0 <> kb THEN 'manual' ELSE 'B' END AS level FROM cl JOIN cc USING (cluster)")
def alias_ladder(spark, d):
    """Names by a ladder of keys: without case and spaces (L1), abbreviations spelt out (A), forms left out (B), pairs by
    hand, and names cut at 18 letters that begin one full name only. Redirects go to the most frequent name, of equals the
    newest. Names are made of part types and brands in five spellings."""
    t, k = F.concat_ws(" ", "p_type", "p_brand", F.lit("PLATED")), F.col("p_partkey") % 5
    raw = (
        F.when(k == 0, F.upper(t)).when(k == 1, F.replace(t, F.lit(" "), F.lit("  "))).when(k == 2, F.replace(F.replace(t, F.lit("STANDARD"), F.lit("STD")), F.lit("PROMOTIONAL"), F.lit("PROMO")))
        .when(k == 3, F.replace(t, F.lit(" PLATED"), F.lit(""))).otherwise(F.left(t, F.lit(18)))
    )
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("id"), raw.alias("raw")).groupBy("raw").agg(F.count("*").alias("n"), F.max("id").alias("newest"))
    l1 = F.lower(F.regexp_replace("raw", r"\s+", ""))
    la = l1
    for short, full in SHORT.items():
        la = F.when(F.startswith(l1, F.lit(full)), la).otherwise(F.regexp_replace(la, f"^{short}", full))
    b0 = F.col("la")
    for form in FORMS:
        b0 = F.replace(b0, F.lit(form), F.lit(""))
    kb = F.col("b0")
    for a, b in MANUAL.items():
        kb = F.when(F.col("b0") == a, b).otherwise(kb)
    n = rows.withColumn("l1", l1).withColumn("la", la).withColumn("b0", b0).withColumn("kb", kb)
    head = F.left("la", F.lit(10)).alias("head")
    full = n.select(head, F.col("la").alias("full_la"), F.col("kb").alias("full_kb"))
    j = n.filter(F.char_length("raw") == 18).select("raw", "la", head).join(full, "head").filter((F.char_length("full_la") > F.char_length("la")) & F.startswith("full_la", "la"))
    cut = j.groupBy("raw").agg(F.count_distinct("full_la").alias("k"), F.min("full_kb").alias("full_kb")).filter("k = 1").drop("k")
    c = n.join(cut, "raw", "left").withColumn("cluster", F.coalesce("full_kb", "kb"))
    newest = F.struct("n", "newest")
    g = c.groupBy("cluster").agg(F.max_by("raw", newest).alias("canonical"), F.count("*").alias("names"), F.max_by("l1", newest).alias("c1"), F.max_by("la", newest).alias("ca"))
    other = F.col("raw") != F.col("canonical")
    level = F.when(~other, "own").when(F.col("l1") == F.col("c1"), "L1").when(F.col("la") == F.col("ca"), "A").when(F.col("kb") != F.col("cluster"), "cut").when(F.col("b0") != F.col("kb"), "manual").otherwise("B")
    return c.join(g, "cluster").select("raw", "canonical", "names", other.alias("redirected"), level.alias("level"))


N3_CHAINS = """nm AS (SELECT p_type || ' ' || p_brand AS name, p_type, substr(p_brand, 7)::INT AS num, count(*) AS n, max(p_partkey) AS newest FROM part GROUP BY ALL), pr AS (SELECT name AS a, p_type || ' Brand#' || (num + 5) AS b FROM nm WHERE num % 7 <> 0),
 e AS (SELECT a, b FROM pr UNION SELECT b, a FROM pr), r AS (SELECT a AS node, a AS root FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node), c AS (SELECT node, min(root) AS comp FROM r GROUP BY 1),
 gr AS (SELECT nm.*, coalesce(comp, name) AS grp FROM nm LEFT JOIN c ON node = name), gg AS (SELECT grp, arg_max(name, (n, newest, name)) AS canonical, count(*) AS names FROM gr GROUP BY 1)"""


@query("N3_hand_chains", f"WITH RECURSIVE {N3_CHAINS} SELECT name, canonical, names FROM gr JOIN gg USING (grp)")
def hand_chains(spark, d):
    """Names of part types and brands under chains of pairs by hand: each brand number with the one five above, but for
    every seventh."""
    p = table(spark, d, "part").withColumn("num", F.substring("p_brand", 7, 9).cast("int"))
    names = p.groupBy(F.concat_ws(" ", "p_type", "p_brand").alias("name"), "p_type", "num").agg(F.count("*").alias("n"), F.max("p_partkey").alias("newest"))
    pairs = names.filter("num % 7 <> 0").select(F.col("name").alias("a"), F.concat(F.col("p_type"), F.lit(" Brand#"), F.col("num") + 5).alias("b"))
    return graph.alias_groups(names, pairs)


@query("N4_abbreviations", "WITH f AS (SELECT DISTINCT p_type AS full_name FROM part), a AS (SELECT DISTINCT left(p_type, 11) AS short FROM part) SELECT short, min(full_name) AS full_name FROM a JOIN f ON starts_with(full_name, short) GROUP BY 1 HAVING count(*) = 1")
def abbreviations(spark, d):
    f = table(spark, d, "part").select(F.col("p_type").alias("full_name")).distinct()
    a = table(spark, d, "part").select(F.left("p_type", F.lit(11)).alias("short")).distinct()
    j = a.join(f.withColumn("short", F.left("full_name", F.lit(11))), "short")
    return j.groupBy("short").agg(F.min("full_name").alias("full_name"), F.count("*").alias("n")).filter("n = 1").drop("n")


#: A customer's digits without the tens, without the units, without leading zeros; orders print the one of the nation.
N4 = """cu AS (SELECT c_custkey AS person, [left(d, 7) || right(d, 1), left(d, 8), ltrim(d, '0')] AS forms, c_nationkey % 3 AS own FROM (SELECT *, substr(c_name, 10) AS d FROM customer)),
 yo AS (SELECT o_custkey AS person, count(*) AS official FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1), ct AS (SELECT forms[own + 1] AS short, sum(official) AS n FROM cu JOIN yo USING (person) GROUP BY 1),
 pp AS (SELECT person, forms, coalesce(official, 0) AS official FROM cu LEFT JOIN yo USING (person)), cd AS MATERIALIZED (SELECT DISTINCT person, short FROM (SELECT person, official, unnest(forms) AS short FROM pp) JOIN ct USING (short) WHERE official > 0 AND n = official),
 r AS (SELECT 0 AS i, person, short, false AS ok FROM cd UNION ALL SELECT i + 1, person, short, acc FROM (SELECT *, bool_or(acc) OVER (PARTITION BY person) OR bool_or(acc) OVER (PARTITION BY short) AS done, bool_or(acc) OVER () AS any_acc FROM (SELECT *, k = 1 AND count(*) FILTER (WHERE k = 1) OVER (PARTITION BY short) = 1 AS acc FROM (SELECT i, person, short, count(*) OVER (PARTITION BY person) AS k FROM r WHERE NOT ok))) WHERE any_acc AND (acc OR NOT done))"""


@query("N4_unique_by_counts", f"WITH RECURSIVE {N4} SELECT person, short, CASE WHEN short IS NOT NULL THEN 'accepted' WHEN official = 0 THEN 'zero' WHEN person NOT IN (SELECT person FROM cd) THEN 'nomatch' WHEN left_ IS NULL THEN 'taken' WHEN left_ = 1 THEN 'shared' ELSE 'many' END AS why, i AS round FROM pp LEFT JOIN (SELECT person, short, i FROM r WHERE ok) USING (person) LEFT JOIN (SELECT person, count(*) AS left_ FROM r WHERE NOT ok AND i = (SELECT max(i) FROM r) GROUP BY 1) USING (person)")
def unique_by_counts(spark, d):
    """The abbreviation of each customer whose count in the orders of 1997 equals the customer's own, by elimination."""
    digits = F.substring("c_name", 10, 100)
    forms = F.array(F.concat(F.left(digits, F.lit(7)), F.right(digits, F.lit(1))), F.left(digits, F.lit(8)), F.ltrim(digits, F.lit("0")))
    cu = table(spark, d, "customer").select(F.col("c_custkey").alias("person"), forms.alias("forms"), (F.col("c_nationkey") % 3).alias("own"))
    yo = table(spark, d, "orders").filter(F.year("o_orderdate") == 1997).groupBy(F.col("o_custkey").alias("person")).agg(F.count("*").alias("official"))
    counted = cu.join(yo, "person").groupBy(F.get("forms", F.col("own")).alias("short")).agg(F.sum("official").alias("n"))
    people = cu.join(yo, "person", "left").select("person", F.coalesce("official", F.lit(0)).alias("official"))
    return matching.unique_candidates(people, cu.select("person", F.explode("forms").alias("short")), counted)


@query("N5_unique_codes", "SELECT o_custkey % 50 AS code, count(*) AS n FROM orders WHERE o_custkey % 50 IN (SELECT o_custkey % 50 FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) = 5) GROUP BY 1")
def unique_codes(spark, d):
    o = table(spark, d, "orders").withColumn("code", F.col("o_custkey") % 50)
    ok = o.groupBy("code").agg(F.size(F.collect_set("o_orderpriority")).alias("k")).filter("k = 5")
    return o.join(ok, "code", "left_semi").groupBy("code").agg(F.count("*").alias("n"))


@query("N6_record_linkage", "WITH l AS (SELECT p_partkey AS id, p_brand AS b, p_size AS s, p_type AS t FROM part WHERE p_partkey % 2 = 0), r AS (SELECT p_partkey AS ref, p_brand AS b, p_size AS s, p_type AS t FROM part WHERE p_partkey % 2 = 1), m1 AS (SELECT id, min(ref) AS ref, count(*) AS n FROM l JOIN r USING (b, s) GROUP BY 1), m2 AS (SELECT id, min(ref) AS ref, count(*) AS n FROM l JOIN r USING (b, s, t) GROUP BY 1) SELECT l.id, CASE WHEN m1.n = 1 THEN m1.ref WHEN m2.n = 1 THEN m2.ref END AS ref, CASE WHEN m1.n = 1 THEN 'first' WHEN m2.n = 1 THEN 'tie-break' WHEN m1.n > 1 THEN 'multi' ELSE 'none' END AS how FROM l LEFT JOIN m1 USING (id) LEFT JOIN m2 USING (id)")
def record_linkage(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("b"), F.col("p_size").alias("s"), F.col("p_type").alias("t"))
    left, right = p.filter("id % 2 = 0"), p.filter("id % 2 = 1").withColumnRenamed("id", "ref")
    # One row for each key of the right side: no pairs of a block.
    stage = lambda keys, n: right.groupBy(*keys).agg(F.min("ref").alias(f"r{n}"), F.count("*").alias(f"n{n}"))
    j = left.join(stage(["b", "s"], 1), ["b", "s"], "left").join(stage(["b", "s", "t"], 2), ["b", "s", "t"], "left")
    one, two = F.col("n1") == 1, F.col("n2") == 1
    how = F.when(one, "first").when(two, "tie-break").when(F.col("n1") > 1, "multi").otherwise("none")
    return j.select("id", F.when(one, F.col("r1")).when(two, F.col("r2")).alias("ref"), how.alias("how"))


@query("N7_identify", with_pt("SELECT p.event, p.runner_no, count(*) FILTER (WHERE abs(q.price - p.price) <= 100) AS candidates, count(*) FILTER (WHERE abs(q.price - p.price) > 100) AS mismatched, round(min(CASE WHEN abs(q.price - p.price) > 100 THEN abs(q.price - p.price) END), 2) AS nearest FROM pt p JOIN pt q ON q.day = p.day AND q.venue = p.venue AND q.runner_no = p.runner_no GROUP BY 1, 2"))
def identify(spark, d):
    """Runs with the printed day, place and number whose value fits, and a report of those that only the value rules out."""
    p = participations(spark, d).select("event", "runner_no", "day", "venue", "price")
    q = p.select("day", "venue", "runner_no", F.col("price").alias("price2"))
    off = F.abs(F.col("price") - F.col("price2"))
    return p.join(q, ["day", "venue", "runner_no"]).groupBy("event", "runner_no").agg(
        F.count_if(off <= 100).alias("candidates"), F.count_if(off > 100).alias("mismatched"), F.round(F.min(F.when(off > 100, off)), 2).alias("nearest")
    )


@query("N8_profiles", "SELECT o_custkey AS id, min(o_orderdate)::DATE AS since, max(o_orderdate)::DATE AS until, count(*) AS n FROM orders GROUP BY 1")
def profiles(spark, d):
    o = table(spark, d, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    return o.groupBy(F.col("o_custkey").alias("id")).agg(F.min("day").alias("since"), F.max("day").alias("until"), F.count("*").alias("n"))


@query("N9_roster", with_snap("SELECT id, CASE WHEN a AND NOT b AND NOT c THEN 'left' WHEN a AND NOT b THEN 'absent once' WHEN a AND NOT c THEN 'absent now' WHEN NOT a AND c AND NOT b THEN 'joined' WHEN NOT a AND b AND NOT c THEN 'seen once' WHEN NOT a THEN 'joined before' ELSE 'stays' END AS state FROM (SELECT id, id % 2 = 0 AS a, id % 3 <> 0 AS b, id % 5 <> 1 AS c FROM so) WHERE a OR b OR c"))
def roster(spark, d):
    """Three nights' rosters: who is missing for the second night in a row has left, who is missing once has not."""
    a, b = snapshots(spark, d)
    c = table(spark, d, "orders").select(F.col("o_orderkey").alias("id")).filter("id % 5 <> 1")
    nights = None
    for name, night in (("a", a), ("b", b), ("c", c)):
        seen = night.select("id", F.lit(True).alias(name))
        nights = seen if nights is None else nights.join(seen, "id", "full_outer")
    a, b, c = (F.coalesce(n, F.lit(False)) for n in "abc")
    state = (
        F.when(a & ~b & ~c, "left").when(a & ~b, "absent once").when(a & ~c, "absent now").when(~a & c & ~b, "joined")
        .when(~a & b & ~c, "seen once").when(~a, "joined before").otherwise("stays")
    )
    return nights.select("id", state.alias("state"))


@query("N10_lifetime", with_pt("SELECT owner, year(day)::INT AS yr, count(*) AS n, count(*) FILTER (WHERE finish = 1) AS wins, count(*) FILTER (WHERE finish <= 3 AND class LIKE 'PROMO%') AS placed FROM pt GROUP BY 1, 2"))
def lifetime(spark, d):
    return participations(spark, d).groupBy("owner", F.year("day").alias("yr")).agg(
        F.count("*").alias("n"), F.count_if(F.col("finish") == 1).alias("wins"), F.count_if((F.col("finish") <= 3) & F.col("class").startswith("PROMO")).alias("placed")
    )


@query("N11_mentions", "SELECT m.id, n_name AS name FROM (SELECT o_orderkey AS id, 'The report names nation ' || 'NATION_' || (o_custkey % 25) || ' today' AS text FROM orders) m JOIN nation ON regexp_matches(m.text, '\\b' || n_name || '\\b')")
def mentions(spark, d):
    """Roster names found in generated sentences: tokens meet the roster by equality, not by scanning all names."""
    text = F.concat(F.lit("The report names nation NATION_"), (F.col("o_custkey") % 25).cast("string"), F.lit(" today"))
    tokens = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.explode(F.array_distinct(F.split(text, " "))).alias("name"))
    return tokens.join(table(spark, d, "nation").select(F.col("n_name").alias("name")), "name").select("id", "name")


#: Roster names of each language as of a document's text; a role word near a name gives it precedence. Fixed values.
ROLES = ("by", "for", "with", "par", "para", "zu")
N11 = r"""tw AS (SELECT doc_id, pos, w FROM (SELECT doc_id, generate_subscripts(p, 1) - 1 AS pos, unnest(p) AS w FROM (SELECT doc_id, string_split_regex(lower(text), '[^\p{L}]+') AS p FROM documents)) WHERE w <> ''),
 ro AS (SELECT item_id AS person, w AS name, left(w, 3) || '.' || right(w, 1) AS short FROM (SELECT item_id, (list_filter(string_split_regex(lower(text), '[^\p{L}]+'), lambda x: length(x) >= 9))[1] AS w FROM benchmark) WHERE w IS NOT NULL),
 rl AS (SELECT doc_id, pos FROM tw WHERE w IN ('by', 'for', 'with', 'par', 'para', 'zu')),
 nx AS (SELECT *, pos - last_value(CASE WHEN w IN ('by', 'for', 'with', 'par', 'para', 'zu') THEN pos END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap FROM tw),
 ex AS (SELECT doc_id, pos, person, gap, 'exact' AS form FROM nx JOIN ro ON w = name),
 fb AS (SELECT doc_id, pos, person, gap, 'short' AS form FROM nx JOIN ro ON left(w, 3) || '.' || right(w, 1) = short AND w <> name WHERE length(w) BETWEEN length(name) - 2 AND length(name) + 2 AND (doc_id, pos) NOT IN (SELECT doc_id, pos FROM ex)),
 al AS (SELECT * FROM ex UNION ALL SELECT * FROM fb), ok AS (SELECT doc_id, pos, min(person) AS person, any_value(gap) AS gap, any_value(form) AS form FROM al GROUP BY 1, 2 HAVING count(DISTINCT person) = 1)"""


@query("N11_linked_mentions", f"WITH {N11} SELECT doc_id, person, form, gap <= 3 AS near_role, pos FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, person ORDER BY form, coalesce(gap, 1000000000), pos) AS k FROM ok) WHERE k = 1".replace("gap <= 3 AS near_role", "coalesce(gap <= 3, false) AS near_role"))
def linked_mentions(spark, d):
    """Roster persons in whole texts of documents: by name, else by its head and last letter at about its length; places
    that fit several persons are dropped; of a person's places in a text the exact one and that nearest behind a role word
    comes first. The roster has each benchmark item's first word of nine letters or more."""
    words = lambda c: F.split(F.lower(c), r"[^\p{L}]+")
    key = lambda w: F.concat(F.left(w, F.lit(3)), F.lit("."), F.right(w, F.lit(1)))
    name = F.get(F.filter(words("text"), lambda w: F.char_length(w) >= 9), 0)
    roster = table(spark, d, "benchmark").select(F.col("item_id").alias("person"), name.alias("name")).filter("name IS NOT NULL").withColumn("short", key(F.col("name")))
    t = table(spark, d, "documents").select("doc_id", F.posexplode(words("text")).alias("pos", "w")).filter("w <> ''")
    behind = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    role = F.last(F.when(F.col("w").isin(*ROLES), F.col("pos")), ignorenulls=True).over(behind)
    t = t.select("doc_id", "pos", "w", (F.col("pos") - role).alias("gap"))
    n = F.char_length("name")
    # Both forms share the short key, so one join finds them; an exact name at a place rules the short forms there out.
    hit = t.withColumn("short", key(F.col("w"))).join(roster, "short").filter(F.char_length("w").between(n - 2, n + 2))
    hit = hit.withColumn("exact", F.col("w") == F.col("name"))
    g = hit.groupBy("doc_id", "pos").agg(F.bool_or("exact").alias("exact"), F.min(F.when(F.col("exact"), F.col("person"))).alias("p1"), F.max(F.when(F.col("exact"), F.col("person"))).alias("p2"), F.min("person").alias("q1"), F.max("person").alias("q2"), F.first("gap").alias("gap"))
    g = g.filter((F.col("exact") & (F.col("p1") == F.col("p2"))) | (~F.col("exact") & (F.col("q1") == F.col("q2"))))
    ok = g.select("doc_id", "pos", F.coalesce("p1", "q1").alias("person"), "gap", F.when(F.col("exact"), "exact").otherwise("short").alias("form"))
    best = F.min_by(F.struct("form", "gap", "pos"), F.struct("form", F.coalesce("gap", F.lit(1000000000)), "pos")).alias("s")
    out = ok.groupBy("doc_id", "person").agg(best)
    return out.select("doc_id", "person", F.col("s.form").alias("form"), F.coalesce(F.col("s.gap") <= 3, F.lit(False)).alias("near_role"), F.col("s.pos").cast("long").alias("pos"))


#: Names of two words from the benchmark items, in rosters of days 0, 10 and 20 that each lack a third of them.
PEOPLE = r"SELECT item_id, CASE WHEN item_id % 2 = 0 THEN 'rider' ELSE 'trainer' END AS kind, regexp_extract(text, '[A-Za-z]{3,} [a-z]{4,}', 0) AS name FROM benchmark"
DATED = f"""ro AS (SELECT DISTINCT since, kind, name FROM ({PEOPLE}) p, (VALUES (0), (10), (20)) s(since) WHERE length(name) > 1 AND item_id % 3 <> since // 10),
 dt AS (SELECT doc_id, text, CASE WHEN doc_id % 30 >= 20 THEN 20 WHEN doc_id % 30 >= 10 THEN 10 ELSE 0 END AS since FROM documents WHERE text IS NOT NULL),
 hd AS (SELECT doc_id, text, kind, name, head, unnest(list_filter(range(1, length(text) - length(head) + 2), lambda i: substr(text, i, length(head)) = head)) AS p FROM (SELECT *, left(name, length(name) - 1) AS head FROM dt JOIN ro USING (since)) WHERE contains(text, head)),
 hp AS (SELECT *, strpos(substr(text, p + length(head), 4), right(name, 1)) AS tail FROM hd),
 hf AS (SELECT *, p + length(head) + tail AS stop, CASE kind WHEN 'rider' THEN 'on' ELSE 'th' END AS word FROM (SELECT *, bool_or(tail = 1) OVER (PARTITION BY doc_id, kind, name) AS any_whole FROM hp) WHERE tail = 1 OR (NOT any_whole AND tail > 0)),
 hn AS (SELECT doc_id, kind, name, p - 1 AS pos, contains(substr(text, greatest(1, p - 12), least(12, p - 1)), word) OR contains(substr(text, stop, 12), word) AS near FROM hf),
 hb AS (SELECT * FROM hn QUALIFY near = bool_or(near) OVER (PARTITION BY doc_id))"""


@query("N11_dated_roster", f"WITH {DATED} SELECT doc_id, any_value(near) AS near, count(DISTINCT (kind, name)) AS persons, CASE WHEN count(DISTINCT (kind, name)) = 1 THEN any_value(kind) END AS kind, CASE WHEN count(DISTINCT (kind, name)) = 1 THEN any_value(name) END AS name, CASE WHEN count(DISTINCT (kind, name)) = 1 THEN min(pos) END AS pos FROM hb GROUP BY 1")
def dated_roster(spark, d):
    """Whole texts of documents against the roster of their day, names of two words: by name, else by head and last letter
    within four letters; places near the kind's role word come first, and a text is linked only if one person is left."""
    name = F.regexp_extract("text", "[A-Za-z]{3,} [a-z]{4,}", 0)
    people = table(spark, d, "benchmark").select("item_id", F.when(F.col("item_id") % 2 == 0, "rider").otherwise("trainer").alias("kind"), name.alias("name"))
    roster = people.withColumn("since", F.explode(F.array(F.lit(0), F.lit(10), F.lit(20)))).filter(F.col("item_id") % 3 != F.floor(F.col("since") / 10))
    texts = table(spark, d, "documents").select("doc_id", "text", (F.col("doc_id") % 30).cast("int").alias("day"))
    places = mention.mentions(texts, roster, key="doc_id", text="text", day="day", since="since", roles={"rider": "on", "trainer": "th"})
    return mention.one_person(places, "doc_id").withColumnRenamed("at", "pos")


@query("R1_head_to_head", with_pt("SELECT a.event, a.one, a.two, count(b.event) AS met, count(*) FILTER (WHERE b.won) AS won FROM pr a LEFT JOIN pr b ON a.one = b.one AND a.two = b.two AND b.d_idx < a.d_idx GROUP BY 1, 2, 3", "pr AS (SELECT * FROM pr0 QUALIFY row_number() OVER (PARTITION BY event, one, two ORDER BY won) = 1)").replace("pr AS (SELECT * FROM pr0", PAIRS.replace("pr AS", "pr0 AS", 1) + ", pr AS (SELECT * FROM pr0"))
def head_to_head(spark, d):
    p = pairs(participations(spark, d)).groupBy("event", "d_idx", "one", "two").agg(F.min("won").alias("won"))
    w = Window.partitionBy("one", "two").orderBy("d_idx").rangeBetween(Window.unboundedPreceding, -1)
    return p.select("event", "one", "two", F.count("*").over(w).alias("met"), F.count_if("won").over(w).alias("won"))


#: One row for each entity of an event (its best place), numbered days, and the pairs that met on each of them.
FIELD = f"""WITH RECURSIVE {PT}, fd AS MATERIALIZED (SELECT event, d_idx, rider AS entity, min(finish)::DOUBLE AS o FROM pt GROUP BY 1, 2, 3),
 ds AS (SELECT d_idx, row_number() OVER (ORDER BY d_idx) AS i FROM (SELECT DISTINCT d_idx FROM fd)), sz AS (SELECT event, count(*) AS n FROM fd GROUP BY 1),
 b AS MATERIALIZED (SELECT i, a.event, a.entity AS one, c.entity AS two, a.o AS o1, c.o AS o2, n FROM fd a JOIN fd c ON a.event = c.event AND a.entity <> c.entity JOIN ds ON ds.d_idx = a.d_idx JOIN sz ON sz.event = a.event),"""
ELO = f"""{FIELD} st AS (SELECT 0::BIGINT AS i, entity, 1500.0::DOUBLE AS rating FROM (SELECT DISTINCT entity FROM fd) UNION ALL
  SELECT s.i + 1, s.entity, s.rating + coalesce(d.delta, 0) FROM st s LEFT JOIN (SELECT b.one, sum(32 / (n - 1) * (CASE WHEN o1 < o2 THEN 1 WHEN o1 = o2 THEN 0.5 ELSE 0 END::DOUBLE - 1 / (1 + pow(10, (r2.rating - r1.rating) / 400)))) AS delta FROM b JOIN st r1 ON r1.entity = b.one AND b.i = r1.i + 1 JOIN st r2 ON r2.entity = b.two GROUP BY 1) d ON d.one = s.entity WHERE s.i < (SELECT max(i) FROM ds))
 SELECT p.entity, p.d_idx, {hu('x.rating', 2)} AS before, {hu('y.rating', 2)} AS rating FROM (SELECT DISTINCT entity, d_idx, i FROM fd JOIN ds USING (d_idx)) p JOIN st x ON x.entity = p.entity AND x.i = p.i - 1 JOIN st y ON y.entity = p.entity AND y.i = p.i"""


def _field(spark, d):
    """One row for each entity of an event, with its best place."""
    return participations(spark, d).groupBy("event", "d_idx", "rider").agg(F.min("finish").alias("place"))


def _rated(spark, d, rule):
    return daily.ratings_by_day(_field(spark, d), rule, day="d_idx", event="event", entity="rider", rank="place")


@query("R2_elo", ELO)
def elo(spark, d):
    """Pairwise Elo by day, K / (n - 1) for each opponent: the rating before and after each day of an entity."""
    out = _rated(spark, d, daily.Elo())
    return out.select("entity", F.col("day").cast("int").alias("d_idx"), stats.half_up(F.col("before_rating"), 2).alias("before"), stats.half_up(F.col("rating"), 2).alias("rating"))


Q10 = "(ln(10) / 400)"
GLICKO = f"""{FIELD} st AS (SELECT 0::BIGINT AS i, entity, 1500.0::DOUBLE AS rating, 350.0::DOUBLE AS dev, NULL::INT AS since, 1500.0::DOUBLE AS r0, 350.0::DOUBLE AS d0 FROM (SELECT DISTINCT entity FROM fd) UNION ALL
  SELECT s.i + 1, s.entity, CASE WHEN p.entity IS NULL THEN s.rating ELSE s.rating + coalesce({Q10} * d.up / (1 / g.dev ** 2 + d.info), 0) END,
   CASE WHEN p.entity IS NULL THEN s.dev ELSE sqrt(1 / (1 / g.dev ** 2 + coalesce(d.info, 0))) END, CASE WHEN p.entity IS NULL THEN s.since ELSE p.d_idx END, s.rating, g.dev
  FROM st s JOIN (SELECT k.entity, least(350, sqrt(k.dev ** 2 + 900 * coalesce(ds.d_idx - k.since, 0) / 30.0::DOUBLE)) AS dev FROM st k JOIN ds ON ds.i = k.i + 1) g ON g.entity = s.entity
  LEFT JOIN (SELECT DISTINCT ds.i, fd.entity, ds.d_idx FROM fd JOIN ds USING (d_idx)) p ON p.entity = s.entity AND p.i = s.i + 1
  LEFT JOIN (SELECT one, sum(3.0 / (n - 1) * gj * (sc - e)) AS up, sum(3.0 / (n - 1) * {Q10} ** 2 * gj * gj * e * (1 - e)) AS info FROM (SELECT *, 1 / (1 + pow(10, -gj * (ra - rb) / 400)) AS e FROM (SELECT b.one, b.n, r1.rating AS ra, r2.rating AS rb, 0.5 + greatest(-3, least(3, o2 - o1)) / 6 AS sc,
     1 / sqrt(1 + 3 * {Q10} ** 2 * least(350, sqrt(r2.dev ** 2 + 900 * coalesce(ds.d_idx - r2.since, 0) / 30.0::DOUBLE)) ** 2 / pi() ** 2) AS gj FROM b JOIN ds ON ds.i = b.i JOIN st r1 ON r1.entity = b.one AND b.i = r1.i + 1 JOIN st r2 ON r2.entity = b.two)) GROUP BY 1) d ON d.one = s.entity
  WHERE s.i < (SELECT max(i) FROM ds))
 SELECT p.entity, p.d_idx, {hu('y.r0', 2)} AS before, {hu('y.d0', 2)} AS before_dev, {hu('y.rating', 2)} AS rating, {hu('y.dev', 2)} AS dev FROM (SELECT DISTINCT entity, d_idx, i FROM fd JOIN ds USING (d_idx)) p JOIN st y ON y.entity = p.entity AND y.i = p.i"""


@query("R3_glicko", GLICKO)
def glicko(spark, d):
    """Glicko by day: deviations that grow with time, scores graded by up to three places, values before and after each day."""
    out = _rated(spark, d, daily.Glicko())
    number = lambda c, n: stats.half_up(F.col(c), 2).alias(n)
    return out.select("entity", F.col("day").cast("int").alias("d_idx"), number("before_rating", "before"), number("before_dev", "before_dev"), number("rating", "rating"), number("dev", "dev"))


R4 = f"WITH RECURSIVE {OH}, s AS (SELECT entity, event, d_idx, price, row_number() OVER (PARTITION BY entity ORDER BY d_idx, event) AS k FROM oh), f AS (SELECT entity, event, k, 150000.0::DOUBLE AS before, d_idx, 150000.0::DOUBLE + 1e9 / (1e9 + 4e9) * (price - 150000.0) AS m, (1 - 1e9 / (1e9 + 4e9)) * 1e9 AS v FROM s WHERE k = 1 UNION ALL SELECT entity, event, k, m, d_idx, m + p / (p + 4e9) * (price - m), (1 - p / (p + 4e9)) * p FROM (SELECT s.entity, s.event, s.k, s.d_idx, s.price, f.m, f.v + 1e6 * (s.d_idx - f.d_idx) AS p FROM f JOIN s ON s.entity = f.entity AND s.k = f.k + 1)) SELECT event, round(before, 2) AS before FROM f"


@query("R4_kalman", R4)
def kalman(spark, d):
    o = order_history(spark, d).select("entity", "event", "d_idx", "price")
    return ratings.kalman(o, "entity", "d_idx", ["event"], "price", prior=150000.0, var=1e9, noise=4e9, per_day=1e6).select("event", F.round("before", 2).alias("before"))


RIDGE = 10


def ridge_sql(rounds: int) -> str:
    """The rounds of `two_way_ridge` as a chain of common tables."""
    steps = ", ".join(
        f"b{k} AS MATERIALIZED (SELECT b.b, sum(s - n * e) / (sum(n) + 20) AS e FROM b JOIN a{k - 1} USING (a) GROUP BY 1), a{k} AS MATERIALIZED (SELECT b.a, sum(s - n * e) / (sum(n) + 5) AS e FROM b JOIN b{k} USING (b) GROUP BY 1)"
        for k in range(1, rounds + 1)
    )
    return f"WITH m AS (SELECT avg(l_quantity) AS m FROM lineitem), b AS MATERIALIZED (SELECT l_partkey AS a, l_suppkey AS b, count(*) AS n, sum(l_quantity - m) AS s FROM lineitem, m GROUP BY 1, 2), a0 AS (SELECT a, sum(s) / (sum(n) + 5) AS e FROM b GROUP BY 1), {steps} SELECT b AS supplier, round(e, 4) AS effect FROM b{rounds}"


def two_way(spark, d, rounds=RIDGE):
    a, b = ratings.two_way_ridge(table(spark, d, "lineitem"), "l_partkey", "l_suppkey", "l_quantity", rounds=rounds)
    return b.select(F.col("l_suppkey").alias("supplier"), F.round("eb", 4).alias("effect"))


query("R5_two_way", ridge_sql(RIDGE))(two_way)
query("R5_two_way_30", ridge_sql(30))(lambda spark, d: two_way(spark, d, 30))


@query("R6_opposition", with_pt("SELECT event, runner_no, round((sum(r) OVER (PARTITION BY event) - r) / nullif(count(*) OVER (PARTITION BY event) - 1, 0), 6) AS others FROM (SELECT event, runner_no, coalesce(rate, 0.25) AS r FROM (SELECT event, runner_no, count(*) FILTER (WHERE finish = 1) OVER w / nullif(count(*) OVER w, 0) AS rate FROM pt WINDOW w AS (PARTITION BY rider ORDER BY d_idx RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))"))
def opposition(spark, d):
    w = Window.partitionBy("rider").orderBy("d_idx").rangeBetween(Window.unboundedPreceding, -1)
    rate = F.try_divide(F.count_if(F.col("finish") == 1).over(w), F.count("*").over(w))
    rows = participations(spark, d).select("event", "runner_no", F.coalesce(rate, F.lit(0.25)).alias("r"))
    e = Window.partitionBy("event")
    return rows.select("event", "runner_no", F.round(F.try_divide(F.sum("r").over(e) - F.col("r"), F.count("*").over(e) - 1), 6).alias("others"))


#: Labels by node that only get smaller; a round passes on those that shrank.
R7 = """WITH RECURSIVE e AS (SELECT DISTINCT l_suppkey AS a, 1000000 + l_partkey AS b FROM lineitem), u AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
  r(node, comp) USING KEY (node) AS (SELECT a, a FROM u GROUP BY a UNION SELECT * FROM (SELECT u.b, min(r.comp) FROM r JOIN u ON u.a = r.node JOIN recurring.r AS k ON k.node = u.b WHERE r.comp < k.comp GROUP BY u.b)) SELECT node, comp FROM r"""


def components(spark, d):
    """Supplier-part links of all of lineitem."""
    li = table(spark, d, "lineitem")
    return graph.components(li.select(F.col("l_suppkey").alias("a"), (1000000 + F.col("l_partkey")).alias("b")).distinct())


query("R7_components", R7)(components)
query("R7_components_all", R7)(components)


R8 = f"""WITH RECURSIVE {PT}, pa AS MATERIALIZED (SELECT event, rider, measure, year(day) AS yr FROM pt), pm AS (SELECT avg(measure) AS m FROM pa), ys AS (SELECT yr, row_number() OVER (ORDER BY yr) AS i FROM (SELECT DISTINCT yr FROM pa)),
 st AS (SELECT 0::BIGINT AS i, rider, 0.0::DOUBLE AS s, 0::BIGINT AS n FROM (SELECT DISTINCT rider FROM pa) UNION ALL
  SELECT st.i + 1, st.rider, st.s + coalesce(d.s, 0), (st.n + coalesce(d.n, 0))::BIGINT FROM st LEFT JOIN (SELECT rider, sum(measure + shift) AS s, count(*) AS n FROM (SELECT event, rider, measure, count(*) OVER e / (count(*) OVER e + 3)::DOUBLE * median(ability - measure) OVER e AS shift FROM (SELECT pa.event, pa.rider, pa.measure, (x.s + 3 * m) / (x.n + 3) AS ability FROM pa JOIN ys USING (yr) JOIN st x ON x.rider = pa.rider AND ys.i = x.i + 1, pm) WINDOW e AS (PARTITION BY event)) GROUP BY 1) d ON d.rider = st.rider WHERE st.i < (SELECT max(i) FROM ys))
 SELECT rider, n, round((s + 3 * m) / (n + 3), 4) AS ability FROM st, pm WHERE i = (SELECT max(i) FROM ys)"""


@query("R8_recursive_form", R8)
def recursive_form(spark, d):
    """Ability adjusted year by year of the data: an entity's mean of adjusted values so far, events shifted by what their
    field shows."""
    from ..operators.baseline import written

    p = participations(spark, d).select("event", "rider", "measure", F.year("day").alias("year"))
    path = io.new_path(spark, "form")
    p.write.partitionBy("year").parquet(path)
    p = spark.read.parquet(path)
    prior = p.agg(F.avg("measure").alias("m")).first()["m"] or 0.0
    state = None
    for year in sorted(r[0] for r in p.select("year").distinct().collect()):  # one value a year
        now = p.filter(F.col("year") == year)
        now = now.withColumn("ability", F.lit(prior)) if state is None else now.join(state, "rider", "left").withColumn("ability", F.coalesce((F.col("s") + 3 * prior) / (F.col("n") + 3), F.lit(prior)))
        shift = now.groupBy("event").agg((F.count("*") / (F.count("*") + 3) * F.percentile(F.col("ability") - F.col("measure"), 0.5)).alias("shift"))
        new = now.join(shift, "event").groupBy("rider").agg(F.sum(F.col("measure") + F.col("shift")).alias("s"), F.count("*").alias("n"))
        if state is not None:
            new = new.unionByName(state).groupBy("rider").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        state = written(new, "form")
    return state.select("rider", "n", F.round((F.col("s") + 3 * prior) / (F.col("n") + 3), 4).alias("ability"))

#: Rows of the first year as they are, then a day a step; `recurring` holds all days so far.
R8_DAYS = f"""WITH RECURSIVE {PT}, pa AS MATERIALIZED (SELECT event, runner_no, rider, class, measure, d_idx, year(day) AS yr FROM pt), dn AS (SELECT d_idx, row_number() OVER (ORDER BY d_idx) AS i FROM (SELECT DISTINCT d_idx FROM pa)), pd AS MATERIALIZED (SELECT pa.*, i FROM pa JOIN dn USING (d_idx)),
 st(event, runner_no, rider, class, yr, d_idx, i, ability, gap, shift, adjusted) USING KEY (event, runner_no) AS (
  SELECT event, runner_no, rider, class, yr, d_idx, i, NULL::DOUBLE, NULL::DOUBLE, 0.0::DOUBLE, measure::DOUBLE FROM pd WHERE yr = (SELECT min(yr) FROM pd)
  UNION SELECT event, runner_no, rider, class, yr, d_idx, i, ability, gap, coalesce(n / (n + 3.0::DOUBLE) * (middle - centre), 0), measure + coalesce(n / (n + 3.0::DOUBLE) * (middle - centre), 0)
  FROM (SELECT *, count(gap) OVER e AS n, median(gap) OVER e AS middle FROM (SELECT *, CASE WHEN known >= 3 THEN ability - measure END AS gap FROM (
   SELECT t.*, coalesce(known, 0) AS known, (coalesce(swv, 0) + coalesce(prior, overall)) / (coalesce(sw, 0) + 1) AS ability, coalesce(centre, 0) AS centre
   FROM (SELECT * FROM pd WHERE i = (SELECT max(i) + 1 FROM st)) t
   LEFT JOIN (SELECT rider, count(*) AS known, sum(w) AS sw, sum(w * adjusted) AS swv FROM (SELECT h.rider, h.adjusted, pow(0.5, (q.d_idx - h.d_idx) / 180.0::DOUBLE) AS w, row_number() OVER (PARTITION BY h.rider ORDER BY h.d_idx DESC, h.event DESC, h.runner_no DESC) AS k FROM recurring.st h JOIN (SELECT DISTINCT rider, d_idx FROM pd WHERE i = (SELECT max(i) + 1 FROM st)) q ON q.rider = h.rider) WHERE k <= 5 GROUP BY rider) l ON l.rider = t.rider
   LEFT JOIN (SELECT h.class, avg(h.adjusted) AS prior FROM recurring.st h, (SELECT min(yr) AS y FROM pd WHERE i = (SELECT max(i) + 1 FROM st)) WHERE h.yr BETWEEN y - 3 AND y - 1 GROUP BY h.class) c ON c.class = t.class,
   (SELECT avg(h.adjusted) AS overall, median(h.gap) AS centre FROM recurring.st h, (SELECT min(yr) AS y FROM pd WHERE i = (SELECT max(i) + 1 FROM st)) WHERE h.yr BETWEEN y - 3 AND y - 1) o)) WINDOW e AS (PARTITION BY event)))
 SELECT event, runner_no, {hu('ability')} AS ability, {hu('shift')} AS shift, {hu('adjusted')} AS adjusted FROM st"""


@query("R8_day_form", R8_DAYS)
def day_form(spark, d):
    """Ability before each day from the last five adjusted values, decayed, with the class's prior; events shifted by what
    their field shows, less the years' own centre."""
    p = participations(spark, d).withColumn("year", F.year("day"))
    out = form.form_by_day(p, day="d_idx", year="year", event="event", no="runner_no", entity="rider", kind="class", value="measure")
    four = lambda c: stats.half_up(F.col(c)).alias(c)
    return out.select("event", F.col("no").cast("int").alias("runner_no"), four("ability"), four("shift"), four("adjusted"))
