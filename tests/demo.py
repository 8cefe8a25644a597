"""Small raw rows with one deliberate fault each, and the results they must give."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tierlake.contracts import Contract
from tierlake.functions.keys import key_hash

# Sample rows, as text.
PANEL = """
Pakistan,2015,Developing,66.5,178,146,0.1,17.6,85,4809,24.6,174,85,2.8,85,0.1,1194.8,185132000,5.3,5.1,0.52,8.1
Pakistan,2014,Developing,66.1,181,152,0.1,16.9,84,4423,24.1,182,82,2.7,84,0.1,1147.0,182142594,5.5,5.3,0.51,7.9
India,2015,Developing,68.3,164,1414,2.6,73.5,78,38545,18.8,1693,72,3.9,72,0.1,1582.4,1293859294,21.5,21.6,0.60,11.7
India,2014,Developing,67.9,167,1447,2.6,68.5,76,31671,18.2,1752,70,3.8,70,0.1,1556.6,1278138903,21.8,22.0,0.59,11.5
Afghanistan,2015,Developing,65.0,263,62,0.01,71.3,65,1154,19.1,83,6,8.2,65,0.1,594.7,33736494,17.2,17.3,0.479,10.1
Afghanistan,2014,Developing,59.9,271,64,0.01,73.5,62,492,18.6,86,58,8.2,62,0.1,612.7,327582,17.5,17.5,0.476,10.0
Iran (Islamic Republic of),2015,Developing,75.4,96,16,0.1,352.0,99,33,23.8,18,99,7.3,99,0.1,4953.0,79109272,3.0,3.0,0.75,15.3
Saudi Arabia,2015,Developing,74.4,89,12,0.0,1574.9,98,220,27.5,14,98,4.4,98,0.1,20376.9,31557144,4.9,5.3,0.84,16.3
Bangladesh,2015,Developing,72.0,128,116,0.0,33.9,97,1093,22.9,140,97,2.7,97,0.1,1086.0,156256278,15.3,15.5,0.56,10.2
China,2015,Developing,76.1,93,162,7.2,419.8,99,1406,'',190,99,5.5,99,0.1,8069.2,1376048943,4.0,3.8,0.73,13.1
'',2015,Developing,66.5,178,146,0.1,17.6,85,4809,24.6,174,85,2.8,85,0.1,1194.8,185132000,5.3,5.1,0.52,8.1
Pakistan,9999,Developing,66.5,178,146,0.1,17.6,85,4809,24.6,174,85,2.8,85,0.1,1194.8,185132000,5.3,5.1,0.52,8.1
Pakistan,2015,Developing,66.5,178,146,0.1,17.6,85,4809,24.6,174,85,2.8,85,0.1,1194.8,185132000,5.3,5.1,0.52,8.1
,,,,,,,,,,,,,,,,,,,,,
"""
OUTBREAK = """
,Pakistan,30.3753,69.3451,2020-03-26,1063,8,17,1038,Eastern Mediterranean
,Pakistan,30.3753,69.3451,2020-06-01,72460,1543,26317,44600,Eastern Mediterranean
,India,20.5937,78.9629,2020-03-26,694,16,64,614,South-East Asia
,India,20.5937,78.9629,2020-06-01,190609,5408,91817,93384,South-East Asia
,Afghanistan,33.9391,67.7100,2020-04-15,714,25,65,624,Eastern Mediterranean
,Afghanistan,33.9391,67.7100,2020-06-01,15205,257,1328,13620,Eastern Mediterranean
,Iran,32.4279,53.6880,2020-03-26,29406,2234,10457,16715,Eastern Mediterranean
,Iran,32.4279,53.6880,2020-06-01,154445,7921,122650,23874,Eastern Mediterranean
,Saudi Arabia,23.8859,45.0792,2020-06-01,87142,524,63224,23394,Eastern Mediterranean
,Bangladesh,23.6850,90.3563,2020-06-01,52445,711,11053,40681,South-East Asia
,China,30.9756,112.2707,2020-01-22,548,17,28,503,Western Pacific
,China,30.9756,112.2707,2020-03-01,79968,2873,41625,35470,Western Pacific
,,0.0,0.0,2020-03-26,100,2,10,88,Unknown
,Unknown,0.0,0.0,13-45-2023,abc,xyz,0,0,Unknown
,Pakistan,30.3753,69.3451,2020-03-26,1063,8,17,1038,Eastern Mediterranean
"""
CAPACITY = """
Pakistan,PAK,2017,0.6
Pakistan,PAK,2018,0.6
India,IND,2017,0.5
India,IND,2018,0.5
Iran,IRN,2017,1.6
Iran,IRN,2018,1.6
Afghanistan,AFG,2017,0.4
Afghanistan,AFG,2018,0.4
Saudi Arabia,SAU,2017,2.2
Saudi Arabia,SAU,2018,2.2
Bangladesh,BGD,2016,0.8
Bangladesh,BGD,2017,0.8
'','',2019,1.0
Unknown,ZZZ,2019,0.5
Pakistan,PAK,2017,0.6
"""


def cells(line: str) -> list[str | None]:
    """Empty is NULL, '' is the empty text."""
    return [None if cell == "" else "" if cell == "''" else cell for cell in line.split(",")]


def rows_of(text: str) -> list[list[str | None]]:
    return [cells(line) for line in text.strip("\n").split("\n")]


def frame(spark: SparkSession, contract: Contract, rows: list) -> DataFrame:
    """Raw frame with ingest columns; the ordinal follows the order of the list."""
    fields = [T.StructField(n, T.StringType()) for n in contract.source_columns]
    schema = T.StructType([*fields, T.StructField("_ordinal", T.LongType())])
    raw = spark.createDataFrame([[*row, i] for i, row in enumerate(rows)], schema).coalesce(1)
    named = raw.withColumn("_src_file", F.lit(contract.label))
    return named.select(
        *contract.source_columns,
        "_src_file",
        F.current_timestamp().alias("_ingested_at"),
        key_hash(list(contract.hash_key)).alias("_row_hash"),
        "_ordinal",
    )


def lake_rows(spark: SparkSession, contracts) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(frame(spark, c, rows_of(t)) for c, t in zip(contracts, (PANEL, OUTBREAK, CAPACITY)))
