"""Entity tables, noisy pool and ground truth, derived from ``part`` by SQL that Spark and DuckDB both run.

Source 1 is one record per part. Source 2 keeps nine in ten of them in upper case with other legal forms and shortened addresses; source 3
keeps seven in ten with reordered, misspelt or domain-like names and missing values. A record's true matches have its part key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FIRST = "Blue,North,Silver,Golden,River,Summit,Pioneer,Harbor,Cedar,Royal,Vertex,Lotus,Falcon,Orchid,Granite,Meadow"
SECOND = "Tools,Foods,Textiles,Motors,Paper,Labs,Books,Dental,Optics,Farms,Garden"
FORMS = "Inc,LLC,Ltd,Services,Pvt Ltd,GmbH,Group,Company"
STREETS = "Oak,Main,Gandhi,Lake,Church,Park,Hill,Station,Market,Victoria,Nehru,Elm,Temple"
KINDS = "Street,Road,Avenue,Lane,Drive,Boulevard,Highway"
CITIES = "Springfield,Mumbai,Lyon,Austin,Pune,Delhi,Salem,Dover,Paris"


def _pick(words: str, index: str) -> str:
    n = len(words.split(","))
    return f"split_part('{words}', ',', CAST(1 + ({index}) % {n} AS INT))"


_NAME = f"{_pick(FIRST, 'p_partkey * 7 + p_partkey % 5')} || ' ' || {_pick(SECOND, 'p_partkey * 3 + p_partkey % 13')} || ' ' || p_name"
_FORM = _pick(FORMS, "p_partkey")
_ADDRESS = f"CAST((p_partkey * 37) % 9000 + 1 AS STRING) || ' ' || {_pick(STREETS, 'p_partkey * 5')} || ' ' || {_pick(KINDS, 'p_partkey')} || ', ' || {_pick(CITIES, 'p_partkey * 11')} || ' ' || CAST(10000 + (p_partkey * 13) % 80000 AS STRING)"
_SHORT = "replace(replace(replace(replace(replace(addr, 'Street', 'St'), 'Road', 'Rd'), 'Avenue', 'Ave'), 'Boulevard', 'Blvd'), 'Highway', 'Hwy')"

#: Common table expressions s1, s2, s3 and pool; the part table is called part.
CTES = f"""
base AS (
  SELECT p_partkey, {_NAME} AS core, {_FORM} AS form, {_ADDRESS} AS addr, replace(p_brand, '#', ' ') AS brand,
         CASE WHEN p_partkey % 10 < 6 THEN 'US' WHEN p_partkey % 10 < 9 THEN 'India' ELSE 'France' END AS country
  FROM part
),
s1 AS (
  SELECT 'S1-' || CAST(p_partkey AS STRING) AS entity_id, CAST(p_partkey AS BIGINT) AS pos, core || ' ' || brand || ' ' || form AS business_name, addr AS business_address, country FROM base
),
s2 AS (
  SELECT 'S2-' || CAST(p_partkey AS STRING) AS entity_id, CAST(p_partkey AS BIGINT) AS pos,
         CASE WHEN p_partkey % 4 = 0 THEN upper(core) WHEN p_partkey % 4 = 1 THEN core || ' Limited' WHEN p_partkey % 4 = 2 THEN core || ', ' || brand ELSE upper(core || ' ' || brand) || ' CO.' END AS business_name,
         CASE WHEN p_partkey % 29 = 0 THEN '' WHEN p_partkey % 3 = 0 THEN upper(addr) ELSE {_SHORT} END AS business_address,
         CASE WHEN p_partkey % 97 = 0 THEN '<MISSING>' ELSE country END AS country
  FROM base WHERE p_partkey % 10 <> 3
),
s3 AS (
  SELECT 'S3-' || CAST(p_partkey AS STRING) AS entity_id, CAST(1000000000000 + p_partkey AS BIGINT) AS pos,
         CASE WHEN p_partkey % 53 = 0 THEN 'NULL' WHEN p_partkey % 7 = 0 THEN lower(replace(core, ' ', '')) || '.com'
              WHEN p_partkey % 7 = 1 THEN brand || ' ' || core WHEN p_partkey % 7 = 2 THEN substring(core, 1, 3) || substring(core, 5) ELSE core || ' ' || form || ' ' || core END AS business_name,
         CASE WHEN p_partkey % 31 = 0 THEN '' WHEN p_partkey % 4 = 0 THEN substring(addr, 1, length(addr) - 6) ELSE {_SHORT} END AS business_address,
         country
  FROM base WHERE p_partkey % 10 NOT IN (1, 5, 7)
),
pool AS (SELECT *, 'S2' AS source FROM s2 UNION ALL SELECT *, 'S3' AS source FROM s3),
truth AS (
  SELECT 'S1-' || CAST(p_partkey AS STRING) AS s1_id, 'S2-' || CAST(p_partkey AS STRING) AS noisy_id, 'S2' AS source FROM base WHERE p_partkey % 10 <> 3 AND p_partkey % 17 <> 0
  UNION ALL
  SELECT 'S1-' || CAST(p_partkey AS STRING) AS s1_id, 'S3-' || CAST(p_partkey AS STRING) AS noisy_id, 'S3' AS source FROM base WHERE p_partkey % 10 NOT IN (1, 5, 7) AND p_partkey % 17 <> 0
)
"""


STATIC, MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


def broadcast_by_measure(spark: SparkSession) -> None:
    """From now on in this session, a join without a hint broadcasts a side only if that side has been computed and its rows are as small as the threshold that held before.

    The size of a table that is not computed is guessed from the files it comes from: a part takes 7 bytes in them, the n-grams and keys made of it thousands.
    """
    most = spark.conf.get(STATIC)
    if most != "-1":
        spark.conf.set(MEASURED, spark.conf.get(MEASURED, None) or most)
        spark.conf.set(STATIC, "-1")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the common table expressions. Sets ``broadcast_by_measure``."""
    broadcast_by_measure(spark)
    # The views' expressions are long; untrimmed, the driver would keep megabytes of plan text for each query.
    spark.conf.set("spark.sql.maxPlanStringLength", 32768)
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", "p_brand")
    cores = spark.sparkContext.defaultParallelism
    if len(part.inputFiles()) < cores:  # one small file would be one task; the views' and keys' expressions are the costly part
        part = part.repartition(cores, "p_partkey")
    return spark.sql(f"WITH part AS (SELECT * FROM {{src}}), {CTES.strip()} SELECT * FROM {name}", src=part)
