"""Adapters that shape the driver tables into catalogue rows.

* ``catalog``: one row per part, all-time review counts (part LEFT JOIN the
  per-part lineitem aggregate). appid = p_partkey, name = p_name, price =
  p_retailprice, genres = "<p_type> | <first word of p_name>", reviews = lines,
  positive = lines not returned ('R'), negative = returned lines.
* ``snapshots``: one Bronze-shaped row per part and extraction run, where a run
  is a ship year and the counts are cumulative up to that year (totals grow
  from run to run as review counts do). Price arrives as localised text.

Each builder is a lazy DataFrame; the lineitem aggregate is partial+final on
``l_partkey`` so the join with ``part`` reuses its hash partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sleeper.schemas import PRICE_TYPE

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Price cap and tier cut-offs that suit the driver data (prices 900..1000).
DRIVER_PRICE_CAP = 1000.0
DRIVER_TIER_S = 0.55
DRIVER_TIER_A = 0.50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _genres() -> F.Column:
    return F.concat_ws(" | ", F.col("p_type"), F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)))


def line_stats(lineitem: DataFrame, by_year: bool = False) -> DataFrame:
    keys = [F.col("l_partkey")]
    if by_year:
        keys.append(F.year("l_shipdate").alias("run"))
    return lineitem.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_resenas"),
        F.count_if(F.col("l_returnflag") != "R").alias("resenas_positivas"),
        F.count_if(F.col("l_returnflag") == "R").alias("resenas_negativas"),
        F.count_if(F.col("l_linestatus") == "O").alias("open_lines"),
        F.min("l_shipdate").alias("first_ship"),
    )


def review_score(pos: str = "resenas_positivas", tot: str = "total_resenas") -> F.Column:
    """0..10 review score: floor(10 * positive / total), NULL without reviews."""
    return F.floor(F.lit(10.0) * F.col(pos) / F.nullif(F.col(tot), F.lit(0))).cast("int")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    stats = line_stats(table(spark, sf_dir, "lineitem"))
    joined = part.join(stats, part.p_partkey == stats.l_partkey, "left")
    return joined.select(
        F.col("p_partkey").alias("appid"),
        F.col("p_name").alias("nombre"),
        _genres().alias("generos"),
        F.col("p_retailprice").cast(PRICE_TYPE).alias("precio"),
        F.coalesce("total_resenas", F.lit(0)).cast("int").alias("total_resenas"),
        F.coalesce("resenas_positivas", F.lit(0)).cast("int").alias("resenas_positivas"),
        F.coalesce("resenas_negativas", F.lit(0)).cast("int").alias("resenas_negativas"),
    ).withColumn("puntuacion", review_score())


def price_text(price: F.Column, style: F.Column) -> F.Column:
    """Localised price text in one of six store formats (style 0..5)."""
    fixed = F.format_string("%.2f", price)
    return (F.when(style == 0, F.concat(F.lit("$"), fixed))
             .when(style == 1, F.concat(F.replace(fixed, F.lit("."), F.lit(",")), F.lit("€")))
             .when(style == 2, F.concat(F.lit("Mex$ "), F.format_number(price * 10, 2)))
             .when(style == 3, F.concat(F.translate(F.format_number(price * 10, 2), ",.", ".,"),
                                        F.lit("€")))
             .when(style == 4, F.concat(F.lit("ARS$ "),
                                        F.translate(F.format_number(price * 10, 0), ",", ".")))
             .otherwise(F.concat(F.lit("S/."), fixed)))


def review_label(pos: str = "resenas_positivas", tot: str = "total_resenas",
                 spanish: F.Column | None = None) -> F.Column:
    share = F.col(pos) / F.nullif(F.col(tot), F.lit(0))
    es = F.coalesce(spanish, F.lit(False)) if spanish is not None else F.lit(False)
    return (F.when(share >= 0.8, F.when(es, F.lit("Extremadamente positivas"))
                   .otherwise(F.lit(" OVERWHELMINGLY Positive ")))
             .when(share >= 0.7, F.when(es, F.lit("Muy positivas")).otherwise(F.lit("Very Positive")))
             .otherwise(F.lit("Mixed")))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped rows (16 columns) plus ``run`` (ship year) per part and run.

    Counts are cumulative over the part's runs (a window partitioned by part:
    one row per part and year, so at most the number of years per partition).
    Some names and prices are withheld by a fixed rule so the data-quality
    rules have rows to reject.
    """
    part = table(spark, sf_dir, "part")
    per_year = line_stats(table(spark, sf_dir, "lineitem"), by_year=True)
    w = Window.partitionBy("l_partkey").orderBy("run").rowsBetween(Window.unboundedPreceding, 0)
    cum = per_year.select(
        "l_partkey", "run", "open_lines",
        F.sum("total_resenas").over(w).alias("total_resenas"),
        F.sum("resenas_positivas").over(w).alias("resenas_positivas"),
        F.sum("resenas_negativas").over(w).alias("resenas_negativas"),
        F.min("first_ship").over(w).alias("first_ship"),
    )
    j = cum.join(part, cum.l_partkey == part.p_partkey, "inner")
    key = F.col("p_partkey")
    meta = F.col("p_size") * 3 - 20
    return j.select(
        key.cast("int").alias("appid"),
        F.when(key % 199 == 7, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("nombre"),
        F.nullif(F.col("open_lines"), F.lit(0)).cast("int").alias("jugadores_actuales_api"),
        F.col("p_brand").alias("desarrolladores"),
        F.col("p_brand").alias("editores"),
        _genres().alias("generos"),
        F.date_format("first_ship", "yyyy-MM-dd").alias("fecha_lanzamiento"),
        F.when(key % 97 == 3, F.lit("Free"))
         .otherwise(price_text(F.col("p_retailprice"), key % 6)).alias("precio"),
        F.when(F.col("p_size") % 10 == 0, F.lit(None).cast("int")).otherwise(meta.cast("int"))
         .alias("metacritic_score"),
        F.when(F.col("p_size") % 10 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("https://example.org/item/"), key.cast("string")))
         .alias("metacritic_url"),
        F.lit("").alias("descripcion_corta"),
        F.col("total_resenas").cast("int").alias("total_resenas"),
        F.col("resenas_positivas").cast("int").alias("resenas_positivas"),
        F.col("resenas_negativas").cast("int").alias("resenas_negativas"),
        review_score().alias("puntuacion"),
        review_label(spanish=(F.col("p_size") % 2 == 0)).alias("descripcion_puntuacion"),
        ((key % 97 == 3) & (F.col("p_size") % 2 == 0)).alias("es_gratis"),
        F.col("run").cast("int").alias("run"),
    )


def faulty_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshots with a fault planted for every rule: by the part key's remainder over 41, one
    column is withheld or set out of its range (prices as text, as they are landed)."""
    key = F.col("appid") % 41
    none = F.lit(None)
    faults = {"appid": {1: none}, "nombre": {2: none}, "precio": {3: none, 14: F.lit("-5.00"), 15: F.lit("S/.35"),
                                                                  16: F.lit("Rs. 99"), 17: F.lit("4,99 pуб.")},
              "total_resenas": {4: none, 13: F.lit(9), 18: F.lit(0)}, "resenas_positivas": {5: none, 11: F.lit(-1),
                                                                                         19: F.lit(100_000)},
              "resenas_negativas": {6: none, 12: F.lit(-1)}, "puntuacion": {7: none, 9: F.lit(101)},
              "metacritic_score": {8: F.lit(101)}, "jugadores_actuales_api": {10: F.lit(-1)}}
    s = snapshots(spark, sf_dir)
    types = dict(s.dtypes)
    out = {}
    for c, planted in faults.items():
        value = F.col(c)
        for k, v in planted.items():
            value = F.when(key == k, v.cast(types[c])).otherwise(value)
        out[c] = value
    return s.withColumns(out)
