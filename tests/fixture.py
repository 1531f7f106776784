"""A hand-made set of sources with known results."""

LABELS = """/* header */
value i94cntyl
   135 =  'UNITED KINGDOM'
   209 =  'JAPAN WRONG'
   245 =  'CHINA, PRC'
   209 =  'JAPAN'
   403 =  'INVALID: STATELESS'
   700 =  'No Country Code (700)'
   999 =  'A = B'
;
value $i94prtl
\t'NYC'\t=\t'NEW YORK, NY    '
\t'LOS'\t=\t'LOS ANGELES, CA'
\t'SFR'\t=\t'SAN FRANCISCO, CA'
\t'WAS'\t=\t'WASHINGTON, DC, X'
\t'XXX'\t=\t'NOT REPORTED/UNKNOWN'
;
value i94model
\t1 = 'Air'
\t2 = 'Sea'
\t3 = 'Land'
\t9 = 'Not reported' ;
value i94addrl
\t'CA'='CALIFORNIA'
\t'FL'='FLORIDA'
\t'NY'='NEW YORK'
;
"""

DEMOGRAPHICS = """\
City;State;Median Age;Male Population;Female Population;Total Population;Number of Veterans;Foreign-born;Average Household Size;State Code;Race;Count
New York;New York;36.0;4081698;4468707;8550405;156961;3212500;2.68;NY;White;3835726
New York;New York;36.0;4081698;4468707;8550405;156961;3212500;2.68;NY;Asian;1304564
New York;New York;36.0;4081698;4468707;8550405;156961;3212500;2.68;NY;Hispanic or Latino;2485125
New York;New York;36.0;4081698;4468707;8550405;156961;3212500;2.68;NY;Black or African-American;2192248
Los Angeles;California;35.0;1958998;2012898;3971896;85417;1485425;2.86;CA;White;2177650
Los Angeles;California;35.1;1958998;2012898;3971896;85417;1485425;2.86;CA;Asian;512999
Boston;Massachusetts;31.8;322149;347317;669469;18350;190123;;MA;White;373113
bad;line
"""

FEED_SCHEMA = (
    "i94port string, i94addr string, i94cit double, i94res double, arrdate double, "
    "i94visa double, i94mode double, i94bir double, biryear double, gender string, "
    "airline string"
)
FEED = [
    ("NYC", "NY", 135.0, 135.0, 20545.0, 2.0, 1.0, 40.0, 1976.0, "M", "BA"),
    ("NYC", "FL", 245.0, 245.0, 20545.0, 3.0, 1.0, 22.0, 1994.0, "F", "CA"),
    ("LOS", "CA", 245.0, 209.0, 20546.0, 3.0, 1.0, 25.0, 1991.0, None, "JL"),
    ("SFR", "CA", 209.0, 209.0, 20546.0, 2.0, 2.0, 30.0, 1986.0, "M", None),
    ("XXX", "NY", 135.0, 135.0, 20546.0, 2.0, 1.0, 31.0, 1985.0, "M", "BA"),
    ("NYC", "NY", 403.0, 135.0, 20547.0, 2.0, 1.0, 50.0, 1966.0, "F", "BA"),
    ("LOS", "CA", 135.0, 135.0, 20547.0, 1.0, None, 33.0, 1983.0, "M", "BA"),
    ("NYC", "NY", 209.0, 135.0, 20547.0, 2.0, 3.0, None, None, "F", None),
]
EXTRA_COLUMNS = [f"extra_{n:02d}" for n in range(1, 18)]

LOCATION = [(1, "LOS", "CA", "LOS ANGELES"), (2, "NYC", "NY", "NEW YORK"), (3, "SFR", "CA", "SAN FRANCISCO")]
COUNTRY = [(135, "UNITED KINGDOM"), (209, "JAPAN"), (245, "CHINA, PRC")]
DATES = [
    (20545, "2016-04-01T00:00:00", 2016, 4, 1, 6, "Fri", 92, 13, 2),
    (20546, "2016-04-02T00:00:00", 2016, 4, 2, 7, "Sat", 93, 13, 2),
    (20547, "2016-04-03T00:00:00", 2016, 4, 3, 1, "Sun", 94, 13, 2),
]
JUNK_IDS = [1011, 1012, 1013, 1019, 1021, 1022, 1023, 1029, 1031, 1032, 1033, 1039]
DEMOGRAPHICS_ROWS = [
    (1, "LOS", "Los Angeles", 35.0, 3971896, None, 2177650, None, None, None),
    (2, "LOS", "Los Angeles", 35.1, 3971896, None, None, None, None, 512999),
    (3, "NYC", "New York", 36.0, 8550405, 2485125, 3835726, 2192248, None, 1304564),
]
# Without the fact's own id.
FACT = [
    (1, 20546, 1031, 245, 209, 1, 25, 1991, None, "JL"),
    (1, 20546, 1031, 245, 209, 2, 25, 1991, None, "JL"),
    (2, 20545, 1021, 135, 135, 3, 40, 1976, "M", "BA"),
    (2, 20545, 1031, 245, 245, 3, 22, 1994, "F", "CA"),
    (2, 20547, 1023, 209, 135, 3, None, None, "F", None),
]


def write_fixture(spark, folder):
    """Write feed, demographics and labels; return their paths."""
    from pyspark.sql import functions as F

    feed = spark.createDataFrame(FEED, FEED_SCHEMA)
    feed = feed.select("*", *[F.lit("").alias(name) for name in EXTRA_COLUMNS])
    paths = {
        "feed_path": str(folder / "feed"),
        "demographics_path": str(folder / "cities.csv"),
        "labels_path": str(folder / "labels.sas"),
    }
    feed.write.parquet(paths["feed_path"])
    (folder / "cities.csv").write_text(DEMOGRAPHICS)
    (folder / "labels.sas").write_text(LABELS)
    return paths
