"""Course-like inputs derived from the star schema, in SQL that Spark and DuckDB both read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Courses of seven universities with levels, intakes and variants told by the URL.
COURSES = """
SELECT p_partkey AS ix,
       concat('uni', CAST(p_partkey % 7 AS STRING)) AS uni,
       concat('https://uni', CAST(p_partkey % 7 AS STRING), '.example.ac.uk/courses/', replace(p_name, ' ', '-'),
              CASE p_partkey % 4 WHEN 0 THEN '-bsc-hons' WHEN 1 THEN '-msc' WHEN 2 THEN '-phd'
                   ELSE '-with-foundation-year' END,
              '-', CASE WHEN p_partkey % 3 = 0 THEN '2026-27' ELSE '2027-28' END) AS url,
       concat(p_name, CASE p_partkey % 4 WHEN 0 THEN ' - BSc (Hons)' WHEN 1 THEN ' MSc' WHEN 2 THEN ' PhD'
                           ELSE ' with Foundation Year' END) AS name,
       CASE p_partkey % 4 WHEN 0 THEN 'undergraduate' WHEN 1 THEN 'postgraduate' WHEN 2 THEN 'postgraduate_research'
            ELSE 'foundation' END AS level,
       p_brand AS brand, p_type AS kind, p_size AS size
FROM part
"""

#: Rows of the course table with holes, bad numbers and bad JSON by the key.
SPARSE = """
SELECT p_partkey AS ix,
       concat('uni', CAST(p_partkey % 7 AS STRING)) AS uniName,
       CASE WHEN p_partkey % 11 = 0 THEN '' ELSE p_brand END AS programmeName,
       p_name AS courseName,
       CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 29 = 0 THEN 'Wizardry' ELSE 'BSc' END AS degreeName,
       CASE WHEN p_partkey % 17 = 0 THEN '  ' ELSE 'HSC' END AS minDegreeName,
       CASE WHEN p_partkey % 19 = 0 THEN 'abc' WHEN p_partkey % 23 = 0 THEN 'None' ELSE '3.5' END AS minGpa,
       CASE WHEN p_partkey % 6 = 0 THEN 'MSc' ELSE '' END AS higherDegreeName,
       CASE WHEN p_partkey % 10 = 0 THEN '3.0' WHEN p_partkey % 12 = 0 THEN 'x' ELSE '' END AS higherGpa,
       CASE WHEN p_partkey % 9 = 0 THEN 'someday' ELSE 'Sep-26' END AS intakeInfo,
       CASE WHEN p_partkey % 31 = 0 THEN 'long' ELSE '12' END AS courseDuration,
       CASE WHEN p_partkey % 8 = 0 THEN '[]' WHEN p_partkey % 21 = 0 THEN '1,2,x' ELSE CAST(p_size * 1000 AS STRING) END AS tuitionFee,
       '' AS initialDeposit, '' AS applicationFee, '' AS scholarshipAmount,
       CASE WHEN p_partkey % 5 = 0 THEN '' ELSE '6.5' END AS ieltsMinOverall,
       '' AS ieltsMinSection, '' AS toeflMinOverall, '' AS toeflMinSection, '' AS pteMinOverall, '' AS pteMinSection,
       CASE WHEN p_partkey % 14 = 0 THEN 'not json'
            WHEN p_partkey % 15 = 0 THEN '[{"subtitle":"Entry","description":"x"}]'
            WHEN p_partkey % 16 = 0 THEN ''
            WHEN p_partkey % 18 = 0 THEN '[{"subtitle":"Entry Requirements","description":["pass"]}]'
            ELSE '[{"subtitle":"Entry Requirements","description":["pass"]},{"subtitle":"English Requirement","description":["IELTS 6.5"]}]'
       END AS AcademicRequirementsMetaData,
       '' AS feesMetaData, '' AS scholarshipMetaData, '' AS scholarshipName,
       CASE p_partkey % 4 WHEN 0 THEN 'undergraduate' WHEN 1 THEN 'postgraduate' WHEN 2 THEN 'postgraduate_research'
            ELSE 'foundation' END AS studyLevel
FROM part
"""

#: Grades in the forms that pages use.
GRADES = """
SELECT l_orderkey * 8 + l_linenumber AS id,
       CASE l_linenumber % 7
         WHEN 0 THEN concat(CAST(CAST(l_quantity AS INT) + 30 AS STRING), '%')
         WHEN 1 THEN concat('Minimum GPA ', CAST(CAST(l_quantity AS INT) % 5 AS STRING), '.25')
         WHEN 2 THEN CASE CAST(l_quantity AS INT) % 4 WHEN 0 THEN 'Upper Second (2:1)' WHEN 1 THEN 'First class honours'
                     WHEN 2 THEN 'a 2:2' ELSE 'Third Class' END
         WHEN 3 THEN concat(CAST(CAST(l_quantity AS INT) * 8 + 24 AS STRING), ' UCAS Tariff points')
         WHEN 4 THEN CASE CAST(l_quantity AS INT) % 4 WHEN 0 THEN 'ABB' WHEN 1 THEN 'CCC overall' WHEN 2 THEN 'DDD' ELSE 'BBC' END
         WHEN 5 THEN 'a good pass'
         ELSE concat('at least ', CAST(CAST(l_quantity AS INT) + 45 AS STRING), ' %') END AS grade,
       CASE l_linenumber % 3 WHEN 0 THEN 'HSC' WHEN 1 THEN 'BSc' ELSE 'MSc' END AS degree
FROM lineitem
"""

#: Intake tokens and durations.
INTAKES = """
SELECT o_orderkey AS id,
       CASE o_orderkey % 6
         WHEN 0 THEN concat(m, ' 2026') WHEN 1 THEN m WHEN 2 THEN concat(CAST(1 + o_orderkey % 31 AS STRING), ' ', m)
         WHEN 3 THEN concat(CAST(1 + o_orderkey % 28 AS STRING), 'th ', m, ' 2027') WHEN 4 THEN 'rolling'
         ELSE concat(m, ', January 2028') END AS token,
       CASE o_orderkey % 5 WHEN 0 THEN '1 year' WHEN 1 THEN '1.5 years' WHEN 2 THEN '18 months' WHEN 3 THEN '24'
         ELSE 'full time' END AS duration
FROM (SELECT o_orderkey, CASE o_orderkey % 12 WHEN 0 THEN 'January' WHEN 1 THEN 'February' WHEN 2 THEN 'march'
        WHEN 3 THEN 'April' WHEN 4 THEN 'May' WHEN 5 THEN 'June' WHEN 6 THEN 'JULY' WHEN 7 THEN 'August'
        WHEN 8 THEN 'September' WHEN 9 THEN 'October' WHEN 10 THEN 'November' ELSE 'December' END AS m FROM orders) t
"""

#: Markdown course pages made of documents.
PAGES = """
SELECT doc_id AS id,
       concat('# ', source, chr(10), '- **Start date:** ', CASE doc_id % 3 WHEN 0 THEN 'September 2026' WHEN 1 THEN 'Sep 2027'
              ELSE 'January 2026 May 2026' END, chr(10), '**Duration:** ', CAST(1 + doc_id % 4 AS STRING), ' years', chr(10),
              CASE WHEN doc_id % 2 = 0 THEN '' ELSE concat('Annual tuition fees: | £', CAST(10 + doc_id % 9 AS STRING), ',500', chr(10)) END,
              CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'IELTS 6.5 with no element below 6.0 please' END, chr(10),
              '## Entry requirements', chr(10), CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'A degree in any subject, 2:1 or above at grade B' END,
              chr(10), '## About', chr(10), text) AS body
FROM documents
"""

NAMES = {"courses": COURSES, "sparse": SPARSE, "grades": GRADES, "intakes": INTAKES, "course_pages": PAGES}


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived input. Its base table is read from the path; nothing is registered under a fixed name."""
    sql = NAMES[name]
    base = sql.rsplit("FROM ", 1)[1].split()[0].strip(")")
    frame = spark.read.parquet(f"{sf_dir}/{base}.parquet")
    quoted = sql.replace("{", "{{").replace("}", "}}").replace(f"FROM {base}", "FROM {source}")
    return spark.sql(quoted, source=frame)
