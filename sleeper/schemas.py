"""Explicit schemas for every layer. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# Bronze: one flat snapshot row per item and run, as landed (16 fields + free flag).
# The landed record's field names, which Silver and Gold read.
BRONZE = StructType([
    StructField("appid", IntegerType()),
    StructField("nombre", StringType()),
    StructField("jugadores_actuales_api", IntegerType()),
    StructField("desarrolladores", StringType()),
    StructField("editores", StringType()),
    StructField("generos", StringType()),
    StructField("fecha_lanzamiento", StringType()),
    StructField("precio", StringType()),
    StructField("metacritic_score", IntegerType()),
    StructField("metacritic_url", StringType()),
    StructField("descripcion_corta", StringType()),
    StructField("total_resenas", IntegerType()),
    StructField("resenas_positivas", IntegerType()),
    StructField("resenas_negativas", IntegerType()),
    StructField("puntuacion", IntegerType()),
    StructField("descripcion_puntuacion", StringType()),
    # added field: the payload's free-to-play flag, so Silver can price a free item at 0.00
    StructField("es_gratis", BooleanType()),
])

BRONZE_COLUMNS = [f.name for f in BRONZE.fields]

# The Bronze -> Silver mapping: (source, source type, target, target type).
SILVER_MAPPING = [(f.name, f.dataType.simpleString(), f.name, f.dataType.simpleString())
                  for f in BRONZE.fields]

PRICE_TYPE = DecimalType(10, 2)

# Silver: the mapped columns with a parsed price, the raw price text and lineage.
SILVER = StructType(
    [f if f.name != "precio" else StructField("precio", PRICE_TYPE) for f in BRONZE.fields]
    + [
        StructField("precio_raw", StringType()),
        StructField("run_ts", TimestampType()),
        StructField("source_file", StringType()),
    ]
)

# Gold: the published table (the 10-column DDL is canonical).
# The column names and types of the published table, as consumers query it.
GOLD = StructType([
    StructField("appid", LongType(), nullable=False),
    StructField("nombre", StringType()),
    StructField("generos", StringType()),
    StructField("precio", DecimalType(8, 2)),
    StructField("puntuacion", IntegerType()),
    StructField("total_resenas", IntegerType()),
    StructField("resenas_positivas", IntegerType()),
    StructField("hidden_gem_score", DecimalType(5, 4)),
    StructField("tier", StringType()),
    StructField("updated_at", TimestampNTZType()),
])

# Raw payload shapes (DDL strings for from_json). Only fields that are read are declared,
# so the JSON parser prunes everything else.
DETAILS_DATA = (
    "struct<type:string,name:string,is_free:boolean,developers:array<string>,"
    "publishers:array<string>,genres:array<struct<description:string>>,"
    "release_date:struct<date:string>,price_overview:struct<final_formatted:string>,"
    "metacritic:struct<score:string,url:string>,short_description:string>"
)
DETAILS_PAYLOAD = f"map<string,struct<success:boolean,data:{DETAILS_DATA}>>"
REVIEWS_PAYLOAD = (
    "struct<query_summary:struct<total_reviews:string,total_positive:string,total_negative:string,"
    "review_score:string,review_score_desc:string>>"
)
# Numbers of the summary; they are sent as numbers or as texts.
REVIEWS_NUMBERS = ("total_reviews", "total_positive", "total_negative", "review_score")
PLAYERS_PAYLOAD = "struct<response:struct<result:int,player_count:string>>"
RANKS_PAYLOAD = "struct<response:struct<ranks:array<struct<appid:string,rank:int>>>>"
SEARCH_PAYLOAD = "struct<total_count:string,results_html:string>"

RUN_FOLDER_FORMAT = "yyyy-MM-dd_HH-mm-ss"
