"""The given tables in the roles of branch (left) and headquarters (right) records.

Every fixture keeps every row of its driving tables and whole texts; parts only lend names to
suppliers and customers of the same number.

ORG   suppliers as branches, customers as headquarters; the names combine a part name, a
      market segment and a legal form, the countries are spelled differently on each side.
PART  parts against parts by type: few distinct names, many copies, rank ties.
PAGE  page titles against page titles by language: accents, junk, uneven lengths.  In the
      relaxed variant a page served over plain http carries its domain instead of its
      language, which no right row has.  In the blank variant every seventh title and every
      fifth language is missing.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred import MatchConfig

LEFT_COUNTRIES = [
    "Bosnia and Herzegovina", "Sao Tome and Principe", "Cote d'Ivoire", "Viet Nam", "Turkiye",
    "Democratic Republic of the Congo", "Republic of the Congo", "Central African Republic",
    "The Gambia", "Taiwan (Province of China)", "Palestine, State of", "United States", "UK",
    "Korea, Republic of", "Eswatini", "Czech Republic", "Hong Kong SAR", "Macau", "Holy See",
    "Great Britain", "Martinique", "Guernsey, Channel Islands", "Timor-Leste", "Réunion", "BVI",
]
RIGHT_COUNTRIES = [
    "Bosnia & Herzegovina", "Sao Tome & Principe", "Côte d'Ivoire", "Vietnam", "Türkiye",
    "Dem. Rep. Congo", "Rep. Of the Congo", "Central African Rep.", "Gambia", "Taiwan",
    "Palestine", "USA", "United Kingdom", "South Korea", "Swaziland", "Czechia", "Hong Kong",
    "Macao", "Vatican City", "United Kingdom", "France", "United Kingdom", "East Timor",
    "France", "British Virgin Islands",
]
LEFT_FORMS = ["Bank", "Société Anonyme", "Incorporated", "Open Joint Stock Company", "Co-operative"]
RIGHT_FORMS = ["Bank (NYS:BNK)", "SA", "«Inc»", "Joint Stock Company", "Aktiengesellschaft", "Corporation", "Trust"]

ORG = MatchConfig(left_id_col="branch_id", right_id_col="entity_id")
PART = MatchConfig(
    left_name_col="p_name", left_country_col="p_type", left_lei_col="p_brand", left_id_col="p_partkey",
    right_name_col="p_name", right_country_col="p_type", right_lei_col="p_brand", right_id_col="p_partkey",
)
PAGE = MatchConfig(
    left_name_col="title", left_country_col="area", left_lei_col="codes", left_id_col="page_id",
    right_name_col="title", right_country_col="area", right_lei_col="codes", right_id_col="page_id",
)
PAGE_RELAXED = replace(PAGE, relax_country=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], number: Column) -> Column:
    texts = F.array(*[F.lit(v) for v in values])
    return F.element_at(texts, (number % len(values) + 1).cast("int"))


def org(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    part = table(spark, sf_dir, "part")
    supplier, customer = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "customer")
    s, c = F.col("s_nationkey"), F.col("c_nationkey")
    left = supplier.join(part, F.col("p_partkey") == F.col("s_suppkey")).select(
        F.col("s_suppkey").alias("branch_id"),
        F.concat_ws(" ", "p_name", _pick(LEFT_FORMS, F.col("s_suppkey"))).alias("institution_name"),
        _pick(LEFT_COUNTRIES, s).alias("country_name"),
        F.concat(F.lit("L"), "s_suppkey", F.lit(" | "), "p_brand").alias("lei"),
        F.col("s_acctbal").alias("balance"),
    )
    right = customer.join(part, F.col("p_partkey") == F.col("c_custkey")).select(
        F.col("c_custkey").alias("entity_id"),
        F.concat_ws(" ", "p_name", "c_mktsegment", _pick(RIGHT_FORMS, F.col("c_custkey"))).alias("SP_ENTITY_NAME"),
        _pick(RIGHT_COUNTRIES, c).alias("SP_COUNTRY_NAME"),
        F.concat(F.lit("L"), "c_custkey").alias("SP_LEI"),
        F.col("c_mktsegment").alias("industry"),
    )
    return left, right


def parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    part = table(spark, sf_dir, "part")
    return part, part


def pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    base = table(spark, sf_dir, "pages").select(
        "page_id",
        "url",
        F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"),
        F.regexp_extract("html", 'lang="(.*?)"', 1).alias("area"),
        F.concat_ws(
            " | ", F.regexp_extract("url", "/([0-9]+)", 1), F.regexp_extract("url", "://([^/]*)/", 1)
        ).alias("codes"),
    )
    return base.drop("url"), base.drop("url")


def pages_moved(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    left, right = pages(spark, sf_dir)
    domain = table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("url", "^http://[^/]*[.]([a-z]+)/", 1).alias("domain")
    )
    moved = left.join(domain, "page_id").withColumn(
        "area", F.when(F.col("domain") != "", F.col("domain")).otherwise(F.col("area"))
    )
    return moved.drop("domain"), right


def pages_blank(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    both, _ = pages(spark, sf_dir)
    both = both.withColumn("title", F.expr("if(page_id % 7 = 0, null, title)")).withColumn(
        "area", F.expr("if(page_id % 5 = 0, null, area)")
    )
    return both, both
