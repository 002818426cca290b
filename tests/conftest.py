import pytest
from pyspark.sql import SparkSession

GEO = [
    ("Algeria", "DZA", "Africa", "Northern Africa"),
    ("Ghana", "GHA", "Africa", "Western Africa"),
    ("Cuba", "CUB", "Americas", "Caribbean"),
    ("Mexico", "MEX", "Americas", "Central America"),
    ("Brazil", "BRA", "Americas", "South America"),
    ("United States", "USA", "Americas", "Northern America"),
    ("China", "CHN", "Asia", "Eastern Asia"),
    ("Iran", "IRN", "Asia", "Southern Asia"),
    ("India", "IND", "Asia", "Southern Asia"),
    ("Bulgaria", "BGR", "Europe", "Eastern Europe"),
    ("Hungary", "HUN", "Europe", "Eastern Europe"),
    ("Poland", "POL", "Europe", "Eastern Europe"),
    ("Romania", "ROU", "Europe", "Eastern Europe"),
    ("Czechia", "CZE", "Europe", "Eastern Europe"),
    ("Norway", "NOR", "Europe", "Northern Europe"),
    ("United Kingdom", "GBR", "Europe", "Northern Europe"),
    ("Spain", "ESP", "Europe", "Southern Europe"),
    ("Austria", "AUT", "Europe", "Western Europe"),
    ("Belgium", "BEL", "Europe", "Western Europe"),
    ("France", "FRA", "Europe", "Western Europe"),
    ("Germany", "DEU", "Europe", "Western Europe"),
    ("Liechtenstein", "LIE", "Europe", "Western Europe"),
    ("Luxembourg", "LUX", "Europe", "Western Europe"),
    ("Monaco", "MCO", "Europe", "Western Europe"),
    ("Netherlands", "NLD", "Europe", "Western Europe"),
    ("Switzerland", "CHE", "Europe", "Western Europe"),
    ("Fiji", "FJI", "Oceania", "Melanesia"),
    ("Palau", "PLW", "Oceania", "Micronesia"),
    ("Nowhere", "NOW", None, None),
]


# Made at import, because test modules build column expressions at import.
SPARK = (
    SparkSession.builder.master("local[4]").appName("tests")
    .config("spark.sql.shuffle.partitions", "4")
    .config("spark.ui.enabled", "false")
    .config("spark.driver.memory", "4g")
    .config("spark.sql.session.timeZone", "UTC")
    .getOrCreate()
)
SPARK.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    return SPARK


@pytest.fixture(scope="session")
def geo(spark):
    rows = [(i, *g) for i, g in enumerate(GEO)]
    return spark.createDataFrame(
        rows, "pos INT, name STRING, alpha3 STRING, continent STRING, subregion STRING"
    ).cache()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Evaluate one expression over a list of strings."""
    def run(expression, values, ddl="x STRING"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i INT, {ddl}")
        out = df.select("i", expression.alias("out")).orderBy("i").collect()
        return [r["out"] for r in out]

    return run
