"""Registered queries of offers and classes, payloads, backfills, routes and artefacts, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import payloads
from lodestone.operators import backfill, cleanup, offers, pages
from lodestone.sources import readers
from lodestone.streaming import progress

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


def _part(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return readers.table(spark, sf_dir, "part").selectExpr(*columns)


_ASKED = """concat(CASE p_size % 6 WHEN 0 THEN 'Upper  Second class honours in ' WHEN 1 THEN 'At least a 2:2 in ' WHEN 2 THEN 'A first class degree, or 2:1, in '
 WHEN 3 THEN 'Good honours degree in ' WHEN 4 THEN '3:2 or third class in ' ELSE 'Experience in ' END, p_name)"""
_TEXT = f"CASE WHEN p_partkey % 9 = 0 THEN ' 21 ' WHEN p_partkey % 10 = 0 THEN NULL ELSE {_ASKED} END"
#: What three universities call their classes, and what these are worth there.
ALIASES = [(u, p, c) for u in (0, 1) for p, c in (("21", "2:1"), ("upper second class honours", "2:1"), ("first class", "first" if u == 0 else "2:1"), ("good honours degree", "2:1"))]
MAPPING = [(0, "2:1", "BSc", "GPA 3.5", "60 - 70%"), (0, "2:2", "BSc", "GPA 3.25", "55%"), (0, "first", "BSc", "GPA 3.5", "70%"), (1, "2:1", "BSc", "CGPA 3.0", ""), (2, "2:2", "BSc", "GPA 2.75", "")]
_values = lambda rows: ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


@query(f"""WITH r AS (SELECT p_partkey AS key, p_partkey % 3 AS uni, {_TEXT} AS t, p_size % 6 AS f, p_partkey % 9 = 0 AS whole, p_partkey % 10 = 0 AND p_partkey % 9 <> 0 AS empty FROM part),
a(uni, phrase, c) AS (VALUES {_values(ALIASES)}), m(uni, c, degree, grade, note) AS (VALUES {_values(MAPPING)}),
p AS (SELECT key, uni, CASE WHEN whole THEN '21' WHEN empty THEN '' ELSE ['upper second class honours', '2:2', 'first class', 'good honours degree', '3:2', ''][f + 1] END AS phrase FROM r),
k AS (SELECT key, p.uni, coalesce(a.c, CASE WHEN p.phrase IN ('2:1', '2:2', '3:2') THEN p.phrase END) AS c FROM p LEFT JOIN a ON a.uni = p.uni AND a.phrase = p.phrase)
SELECT key, k.c AS uk_class, degree, grade, note FROM k LEFT JOIN m ON m.uni = k.uni AND m.c = k.c""")
def class_requirements(spark, sf_dir):
    rows = _part(spark, sf_dir, "p_partkey AS key", "p_partkey % 3 AS uni", f"{_TEXT} AS text")
    aliases = spark.createDataFrame(ALIASES, "uni long, phrase string, uk_class string")
    mapping = spark.createDataFrame(MAPPING, "uni long, uk_class string, degree string, grade string, note string")
    found = offers.class_requirements(rows, "uni", "text", aliases, mapping)
    return found.select("key", "uk_class", "degree", "grade", "note")


RULES = [(0, "undergraduate", 1, r"2\s+year\s+undergraduate", "BA", "60%"), (0, "undergraduate", 2, "", "HSC", "CGPA 5.0"), (0, "foundation", 1, "", "HSC", "GPA 2.00"), (1, "foundation", 1, "hsc|alim", "HSC", "GPA 3.0")]
_LEVEL = "CASE p_size % 3 WHEN 0 THEN 'undergraduate' WHEN 1 THEN 'foundation' ELSE 'postgraduate' END"
_DEFAULT = "CASE p_partkey % 4 WHEN 0 THEN 'A 2 Year  undergraduate course' WHEN 1 THEN 'HSC or Alim' WHEN 2 THEN NULL ELSE p_name END"


@query(f"""SELECT p_partkey AS key,
  CASE WHEN p_partkey % 2 = 0 AND l = 'undergraduate' THEN CASE WHEN p_partkey % 4 = 0 THEN 'BA' ELSE 'HSC' END
    WHEN p_partkey % 2 = 0 AND l = 'foundation' THEN 'HSC' WHEN l = 'foundation' AND p_partkey % 4 = 1 THEN 'HSC' END AS degree,
  CASE WHEN p_partkey % 2 = 0 AND l = 'undergraduate' THEN CASE WHEN p_partkey % 4 = 0 THEN '60%' ELSE 'CGPA 5.0' END
    WHEN p_partkey % 2 = 0 AND l = 'foundation' THEN 'GPA 2.00' WHEN l = 'foundation' AND p_partkey % 4 = 1 THEN 'GPA 3.0' END AS grade
FROM (SELECT p_partkey, {_LEVEL} AS l FROM part)""")
def level_defaults(spark, sf_dir):
    rows = _part(spark, sf_dir, "p_partkey AS key", "p_partkey % 2 AS uni", f"{_LEVEL} AS level", f"{_DEFAULT} AS text")
    rules = spark.createDataFrame(RULES, "uni long, level string, place int, pattern string, degree string, grade string")
    return offers.level_defaults(rows, "key", "uni", "level", "text", rules).select("key", "degree", "grade")


_A = "substr('ABCD', CAST(1 + p_size % 4 AS INT), 1)"
_B = "substr('ABCD', CAST(1 + p_partkey % 4 AS INT), 1)"
_C = "substr('DCBA', CAST(1 + (p_partkey + p_size) % 4 AS INT), 1)"
_OFFER = f"concat({_A}, {_B}, {_C})"
_OTHER = f"concat({_B}, {_B}, {_A})"
_ENTRY = f"""CASE p_partkey % 5 WHEN 0 THEN concat('Typical offer ', lower({_OFFER}), ' - ', {_OTHER}, ' (A-level)') WHEN 1 THEN concat({_OFFER}, ' (A-level) or more')
 WHEN 2 THEN concat({_OTHER}, '–', {_OFFER}, ' (A-LEVEL)') WHEN 3 THEN 'AAB-ABB (A-level)' ELSE concat(p_name, ' ', {_OFFER}) END"""
BANDS = [(0, "AAB-ABB", "4.75"), (0, "BBB", "4.1"), (1, "AAB-ABB", "4.5")]
STANDARD = [(0, "ABB", "4.6"), (0, "CCC", "3.3"), (1, "BBB", "4.2"), (1, "AAD", "4.0")]
_SORTED = lambda x: f"array_to_string(list_sort(string_split({x}, '')), '')"
_RANKS = lambda x: f"list_sum(list_transform(string_split({x}, ''), lambda g: ascii(g)))"


@query(f"""WITH r AS (SELECT p_partkey AS key, p_partkey % 2 AS uni, p_partkey % 5 AS f, {_OFFER} AS a, {_OTHER} AS b FROM part),
l AS (SELECT key, uni, CASE f WHEN 0 THEN concat(a, '-', b) WHEN 1 THEN a WHEN 2 THEN concat(b, '-', a) WHEN 3 THEN 'AAB-ABB' ELSE '' END AS label,
  CASE f WHEN 0 THEN a WHEN 1 THEN a WHEN 2 THEN b WHEN 3 THEN 'AAB' END AS low, CASE f WHEN 0 THEN b WHEN 1 THEN a WHEN 2 THEN a WHEN 3 THEN 'ABB' END AS high FROM r),
o AS (SELECT *, CASE WHEN label = '' THEN NULL WHEN {_RANKS("low")} >= {_RANKS("high")} THEN {_SORTED("low")} ELSE {_SORTED("high")} END AS offer FROM l),
b(uni, label, points) AS (VALUES {_values(BANDS)}), s(uni, offer, points) AS (VALUES {_values(STANDARD)}),
c(offer, points) AS (VALUES ('AAA', '5'), ('AAB', '5'), ('ABB', '5'), ('BBB', '4'), ('BBC', '4'), ('BCC', '3.5'), ('CCC', '3.5'), ('CCD', '3.5'), ('CDD', '3.5'), ('DDD', '2'))
SELECT key, o.label AS label, o.offer AS offer, coalesce(b.points, s.points, c.points) AS points,
  CASE WHEN b.points IS NOT NULL THEN 'band' WHEN s.points IS NOT NULL THEN 'standard' WHEN c.points IS NOT NULL THEN 'scale' END AS by
FROM o LEFT JOIN b ON b.uni = o.uni AND b.label = o.label LEFT JOIN s ON s.uni = o.uni AND s.offer = o.offer LEFT JOIN c ON c.offer = o.offer""")
def offer_ranges(spark, sf_dir):
    rows = _part(spark, sf_dir, "p_partkey AS key", "p_partkey % 2 AS uni", f"{_ENTRY} AS text").withColumn("label", offers.offer_label(F.col("text")))
    bands = spark.createDataFrame(BANDS, "uni long, label string, points string")
    standard = spark.createDataFrame(STANDARD, "uni long, offer string, points string")
    return offers.offer_points(rows, "uni", F.col("label"), bands, standard).select("key", "label", "offer", "points", "by")


_PAYLOAD = """CASE p_partkey % 8
 WHEN 0 THEN concat('[{"degree":"bsc","grade":"GPA 3.', CAST(p_size % 10 AS STRING), '"},{"Degree":"HSC","grade":"', CAST(p_size AS STRING), '%."},{"degree":"BSc","grade":"GPA 3.', CAST(p_size % 10 AS STRING), '"}]')
 WHEN 1 THEN concat('{"degrees":[{"degree":"MSc","grade":', CAST(p_size + 50 AS STRING), '},null,"CGPA 3.', CAST(p_size % 10 AS STRING), '"]}')
 WHEN 2 THEN concat('[[["CGPA 2.', CAST(p_size % 10 AS STRING), '", 7], {"Requirements":[{"entryRequirements":["', CAST(p_size AS STRING), '%"]}]}]]')
 WHEN 3 THEN concat('{"qualification":"Bachelor","description":"with CGPA 3.', CAST(p_size % 10 AS STRING), ' or ', CAST(p_size AS STRING), '%","requirements":[]}')
 WHEN 4 THEN concat('not json, CGPA 3.', CAST(p_size % 10 AS STRING))
 WHEN 5 THEN '"" ' WHEN 6 THEN NULL ELSE concat(CAST(p_size AS STRING)) END"""


def _read(text):
    return pages.required(text, [(r"CGPA\s*([\d.]+)", "BSc", "$1"), (r"(\d+)\s*%", "HSC", "$1")])


@query("""SELECT key, n, degree, grade FROM (SELECT p_partkey AS key, unnest(CASE p_partkey % 8
  WHEN 0 THEN [['BSc', concat('GPA 3.', p_size % 10)], ['HSC', concat(p_size, '%')]]
  WHEN 1 THEN [['MSc', CAST(p_size + 50 AS VARCHAR)], ['BSc', concat('3.', p_size % 10)]]
  WHEN 2 THEN [['BSc', concat('2.', p_size % 10)], ['HSC', CAST(p_size AS VARCHAR)]]
  WHEN 3 THEN [['BSc', concat('3.', p_size % 10)], ['HSC', CAST(p_size AS VARCHAR)]]
  WHEN 4 THEN [['BSc', concat('3.', p_size % 10)]] ELSE [] END) AS pair, generate_subscripts(CASE p_partkey % 8 WHEN 4 THEN [1] WHEN 0 THEN [1, 2] WHEN 1 THEN [1, 2] WHEN 2 THEN [1, 2] WHEN 3 THEN [1, 2] ELSE [] END, 1) AS n FROM part),
LATERAL (SELECT pair[1] AS degree, pair[2] AS grade)""")
def payload_requirements(spark, sf_dir):
    rows = _part(spark, sf_dir, "p_partkey AS key", f"{_PAYLOAD} AS payload")
    found = rows.select("key", F.posexplode(payloads.payload_requirements(F.col("payload"), _read)).alias("at", "r"))
    return found.select("key", (F.col("at") + 1).cast("long").alias("n"), "r.degree", "r.grade")


@query("""SELECT p_partkey AS key, CASE WHEN p_partkey % 3 = 0 THEN CASE WHEN p_partkey % 2 = 0 THEN '' ELSE p_brand END ELSE p_type END AS fee,
  CASE WHEN p_partkey % 3 = 0 AND p_partkey % 6 <> 0 THEN p_brand ELSE p_type END AS intake,
  CASE WHEN p_partkey % 3 = 0 AND p_size % 2 = 0 THEN concat(p_brand, ';', p_size) ELSE concat(p_type, ';', p_size) END AS notes,
  concat(CASE WHEN p_partkey % 3 = 0 THEN 'fee ' ELSE '' END, CASE WHEN p_partkey % 3 = 0 AND p_partkey % 6 <> 0 THEN 'intake ' ELSE '' END,
    CASE WHEN p_partkey % 3 = 0 AND p_size % 2 = 0 THEN 'notes ' ELSE '' END) AS changed FROM part""")
def backfilled_records(spark, sf_dir):
    note = lambda name, empty: f"CASE WHEN {empty} THEN array() ELSE array(named_struct('name', {name}, 'size', p_size)) END AS notes"
    stored = _part(spark, sf_dir, "p_partkey AS key", "p_type AS fee", "p_type AS intake", note("p_type", "false"))
    fresh = readers.table(spark, sf_dir, "part").where("p_partkey % 3 = 0")
    fresh = fresh.selectExpr("p_partkey AS key", "if(p_partkey % 2 = 0, '', p_brand) AS fee", "if(p_partkey % 6 = 0, ' ', p_brand) AS intake", note("p_brand", "p_size % 2 = 1"))
    found = backfill.backfilled(stored, fresh, "key", ["fee"], ["intake", "notes"])
    notes = F.array_join(F.transform("notes", lambda x: F.concat_ws(";", x["name"], x["size"].cast("string"))), ",")
    return found.select("key", "fee", "intake", notes.alias("notes"), F.array_join(F.transform("changed", lambda c: F.concat(c, F.lit(" "))), "").alias("changed"))


_ROUTES = """concat('# ', p_name, chr(10), 'Intro', chr(10), CASE WHEN p_partkey % 4 = 3 THEN '' ELSE concat('## Entry requirements: Contextual degree offer', chr(10), 'Offer ', p_brand, chr(10)) END,
 CASE WHEN p_partkey % 4 = 0 THEN concat('## Entry requirements: BSc with Foundation Year', chr(10), 'Less ', CAST(p_size AS STRING), chr(10), '#### 2024', chr(10), 'old', chr(10)) ELSE '' END,
 CASE WHEN p_partkey % 4 = 1 THEN concat('## Entry requirements', chr(10), p_type, chr(10)) ELSE '' END, '## Fees', chr(10), 'none')"""
_WANTED = "CASE p_size % 3 WHEN 0 THEN 'undergraduate' WHEN 1 THEN 'foundation' ELSE 'postgraduate' END"


@query(f"""WITH r AS (SELECT p_partkey AS key, p_partkey % 4 AS f, {_WANTED} AS level, concat('## Entry requirements: Contextual degree offer', chr(10), 'Offer ', p_brand) AS ug,
  concat('## Entry requirements: BSc with Foundation Year', chr(10), 'Less ', p_size, chr(10), '#### 2024', chr(10), 'old') AS fy, concat('## Entry requirements', chr(10), p_type) AS pg FROM part)
SELECT key, CASE WHEN f = 3 THEN 'legacy' WHEN level = 'undergraduate' THEN ug WHEN level = 'foundation' THEN CASE WHEN f = 0 THEN fy ELSE '' END WHEN f = 1 THEN pg ELSE ug END AS block FROM r""")
def picked_routes(spark, sf_dir):
    rows = _part(spark, sf_dir, "p_partkey AS key", f"{_WANTED} AS level", f"{_ROUTES} AS body")
    routes = [("foundation", "foundation year"), ("undergraduate", "contextual|degree")]
    found = rows.withColumn("routes", cleanup.route_blocks(F.col("body"), r"(?i)^##\s+Entry requirements:?\s*(.*)$", routes, "postgraduate"))
    return found.select("key", cleanup.picked_route(F.col("routes"), F.col("level"), F.lit("postgraduate"), F.lit("legacy")).alias("block"))


_YEARS = """concat('### Entry', chr(10), 'first ', p_brand, chr(10), '#### Entry 2025', chr(10), 'a', chr(10), '#### Entry ', CASE WHEN p_partkey % 2 = 0 THEN '2026' ELSE '2025' END, chr(10), 'b ', p_type, chr(10),
 '### More', chr(10), 'kept', chr(10), '#### Entry 2024', chr(10), 'old', chr(10), '#### Other', chr(10), 'x')"""


@query("""SELECT p_partkey AS key, concat('### Entry', chr(10), 'first ', p_brand, chr(10), CASE WHEN p_partkey % 2 = 0 THEN concat('#### Entry 2026', chr(10), 'b ', p_type)
  ELSE concat('#### Entry 2025', chr(10), 'a', chr(10), '#### Entry 2025', chr(10), 'b ', p_type) END, chr(10), '### More', chr(10), 'kept') AS body FROM part""")
def latest_years_in_place(spark, sf_dir):
    lines = cleanup.numbered_lines(_part(spark, sf_dir, "p_partkey AS key", f"{_YEARS} AS body"), "key", "body")
    return cleanup.rejoined(cleanup.latest_year_in_place(lines, "key", r"^####\s+Entry\s+(20\d{2})"), "key", "body")


@query("""WITH f AS (SELECT p_partkey % 13 AS u, p_partkey AS k, p_size AS s FROM part),
n AS (SELECT concat('uni', u) AS university, count(*) FILTER (WHERE k % 2 = 0 AND s > 1) AS md, count(*) FILTER (WHERE k % 2 = 0 AND s <= 1) AS md0,
  count(*) FILTER (WHERE k % 2 = 1 AND k % 3 = 0) AS html, count(*) FILTER (WHERE k % 2 = 0 AND s > 1 AND u < 8 AND (u < 4 OR s > 25)) AS js FROM f GROUP BY u),
p AS (SELECT university, 'download' AS phase, CASE WHEN university = 'uni1' THEN 0 WHEN university = 'uni2' THEN 1 ELSE 1000000 END AS expected, md AS done, html + md0 AS begun FROM n
  UNION ALL SELECT university, 'extract', md, js, 0 FROM n)
SELECT university, phase, CAST(expected AS BIGINT) AS expected, CAST(done AS BIGINT) AS done, CAST(begun AS BIGINT) AS begun,
  CASE WHEN expected = 0 THEN 'missing' WHEN done >= expected THEN 'done' WHEN done > 0 THEN 'partial' WHEN begun > 0 THEN 'in_progress' ELSE 'not_started' END AS status FROM p""")
def artefact_states(spark, sf_dir):
    uni, key = "concat('/data/uni', CAST(p_partkey % 13 AS STRING), '/output/')", "CAST(p_partkey AS STRING)"
    page = _part(spark, sf_dir, f"if(p_partkey % 2 = 0, concat({uni}, 'clean/courses/ug/', {key}, '.md'), concat({uni}, if(p_partkey % 3 = 0, 'course_pages/', 'other/'), {key}, '.html')) AS path", "if(p_size > 1, 1L, 0L) AS length")
    told = readers.table(spark, sf_dir, "part").where("p_partkey % 2 = 0 and p_size > 1 and p_partkey % 13 < 8 and (p_partkey % 13 < 4 or p_size > 25)")
    told = told.selectExpr(f"concat({uni}, 'extracted/ug/', {key}, '/output.json') AS path", "1L AS length")
    files = page.unionAll(told).withColumn("time", F.lit("2026-09-01").cast("timestamp"))
    expected = _part(spark, sf_dir, "concat('uni', CAST(p_partkey % 13 AS STRING)) AS university").distinct()
    expected = expected.select("university", F.lit("download").alias("phase"), F.expr("CASE university WHEN 'uni1' THEN 0L WHEN 'uni2' THEN 1L ELSE 1000000L END").alias("n"))
    return progress.artefact_states(files, expected, progress.PHASES[:2]).drop("latest")
