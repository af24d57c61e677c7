"""Energy and weather feeds derived from the ``events`` table.

Event types play the zones (energy) and the places (weather), hours of ``ts``
the hourly grain. Every hour is delivered several times: payloads come every 12
hours, energy ones cover the 24 hours before, weather ones also the 24 after.
Hours are aggregated first, so a payload has at most 48 entries however many
events there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridtide.schemas import ENERGY_COLUMNS, FUELS, MEASURES, NEIGHBOURS, WEATHER_COLUMNS
from gridtide.session import use_utc

BATCH_HOURS = 12
FUEL_WIDTH = 12  # k lies in 0..99: nine ranges of twelve
BANDS = ((None, 10), (10, 20), (20, 40), (40, None))  # ranges of value, one per neighbour
CARBON_MIN = 10  # hours with a smaller sum of k have no carbon entry
PLACES = {
    "click": "Athens, Greece", "view": "Heraklion, Greece", "purchase": "Thessaloniki, Greece",
    "signup": "Patras, Greece", "error": "Volos, Greece",
}
ISO = "yyyy-MM-dd'T'HH:mm:ss"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A driver table with its times as instants (UTC)."""
    use_utc(spark)
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    zoned = [F.col(c).cast("timestamp").alias(c) if t == "timestamp_ntz" else F.col(c) for c, t in df.dtypes]
    return df.select(*zoned)


def prop_k() -> Column:
    return F.from_json("props", "map<string,bigint>")["k"]


def in_band(low, high) -> str:
    tests = [f"value >= {low}"] * (low is not None) + [f"value < {high}"] * (high is not None)
    return " AND ".join(tests)


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (zone, h) with the sums that the feeds are made of; map-side combined."""
    events = load(spark, sf_dir, "events").select(
        F.col("event_type").alias("zone"), F.date_trunc("hour", "ts").alias("h"), "value", prop_k().alias("k")
    )
    sums = {
        "n": "count(*)", "sk": "sum(k)", "mx": "max(k)", "mn": "min(k)",
        "cents": "sum(CAST(round(value * 100) AS BIGINT))",
        "lo": "count(IF(value < 20, 1, NULL))", "hi": "count(IF(value >= 20, 1, NULL))",
    }
    for i, f in enumerate(FUELS):
        mine = f"k div {FUEL_WIDTH} = {i}"
        sums |= {f"consumption_{f}": f"sum(IF({mine}, 1L, NULL))", f"production_{f}": f"sum(IF({mine}, k, NULL))"}
    for nb, band in zip(NEIGHBOURS, BANDS):
        mine = in_band(*band)
        sums |= {f"import_{nb}": f"sum(IF({mine}, 1L, NULL))", f"export_{nb}": f"sum(IF({mine}, k, NULL))"}
    return events.groupBy("zone", "h").agg(*[F.expr(f"{x} AS {name}") for name, x in sums.items()])


def next_batch() -> Column:
    """First delivery time at or after ``h``."""
    step = BATCH_HOURS * 3600
    return F.timestamp_seconds(F.ceil(F.unix_timestamp("h") / step) * step)


def plus_hours(ts: Column, hours) -> Column:
    return ts + F.make_dt_interval(F.lit(0), hours if isinstance(hours, Column) else F.lit(hours))


def plus_minutes(ts: Column, minutes: int) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))


def deliveries(hours: DataFrame, lags: tuple[int, ...]) -> DataFrame:
    """A copy of each hour per delivery ``v``, ``lag`` being its batches after the first possible one."""
    lag = F.explode(F.array(*[F.lit(x) for x in lags])).alias("lag")
    return hours.select("*", lag).withColumn("v", plus_hours(next_batch(), F.col("lag") * BATCH_HOURS))


def _payloads(entries: DataFrame, entry: Column) -> DataFrame:
    payload = F.to_json(F.struct("zone", F.sort_array(F.collect_list(entry)).alias("history")))
    return entries.groupBy("zone", "v").agg(payload.alias("raw_json"))


def _bronze(payloads: DataFrame, source: str, minutes: int) -> DataFrame:
    return payloads.select(
        F.lit(source).alias("source"), "raw_json", plus_minutes(F.col("v"), minutes).alias("ingested_at")
    )


def _stamp() -> Column:
    return F.concat(F.date_format("h", ISO), F.lit(".000Z")).alias("datetime")


def power_payloads(spark: SparkSession, sf_dir: str, lags: tuple[int, ...] = (0, 1)) -> DataFrame:
    """Power payloads by zone and delivery; an hour's first delivery is an estimate, one too high."""
    def part(name, keys):
        return F.struct(*[F.col(f"{name}_{x}").alias(x) for x in keys]).alias(f"power{name.title()}Breakdown")

    first = F.col("lag") == 0
    entry = F.struct(
        _stamp(), "zone", part("consumption", FUELS), part("production", FUELS),
        part("import", NEIGHBOURS), part("export", NEIGHBOURS),
        (F.col("n") + first.cast("int")).alias("powerConsumptionTotal"), F.col("sk").alias("powerProductionTotal"),
        F.col("hi").alias("powerImportTotal"), F.col("lo").alias("powerExportTotal"), first.alias("isEstimated"),
    )
    return _payloads(deliveries(hourly(spark, sf_dir), lags), entry)


def power_bronze(spark: SparkSession, sf_dir: str, lags: tuple[int, ...] = (0, 1)) -> DataFrame:
    """Power payloads as they lie in bronze."""
    return _bronze(power_payloads(spark, sf_dir, lags), "power_data", 10)


def carbon_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carbon payloads by zone and delivery; hours with little activity have no entry."""
    entry = F.struct(
        _stamp(), "zone", F.expr("cents div n").alias("carbonIntensity"), (F.col("lag") == 0).alias("isEstimated")
    )
    hours = hourly(spark, sf_dir).filter(F.col("sk") >= CARBON_MIN)
    return _payloads(deliveries(hours, (0, 1)), entry)


def carbon_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carbon payloads as they lie in bronze."""
    return _bronze(carbon_payloads(spark, sf_dir), "carbon_intensity", 11)


WEATHER_LAGS = (-2, -1, 0, 1)


def _weather_values(hours: DataFrame, lags: tuple[int, ...] = WEATHER_LAGS) -> DataFrame:
    """One row per (place, h, v); the temperature is revised with every delivery."""
    place = F.create_map(*[F.lit(x) for kv in PLACES.items() for x in kv])[F.col("zone")]
    measures = {
        "temp": (F.expr("cents div n") + F.col("lag")) / 100.0,
        "humidity": F.col("n").cast("double"),
        "precip": F.when(F.col("n") > 1, F.col("mx")).cast("double"),
        "windspeed": F.col("mn").cast("double"),
        "winddir": (F.col("sk") % 360).cast("double"),
        "cloudcover": F.col("lo").cast("double"),
        "solarenergy": F.col("cents") / 100.0,
    }
    return deliveries(hours, lags).select(
        place.alias("name"), F.lit(37.5).alias("latitude"), F.lit(23.75).alias("longitude"), "h", "v",
        *[c.alias(m) for m, c in measures.items()], F.concat(F.lit("S1,"), F.col("zone")).alias("stations"),
    )


def weather_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather payloads by place and delivery: CSV text with one header line, local times, quoted names."""
    values = _weather_values(hourly(spark, sf_dir))

    def quoted(c):
        return F.concat(F.lit('"'), F.col(c), F.lit('"'))

    local = F.date_format(F.from_utc_timestamp("h", "EET"), ISO)
    texts = {"name": quoted("name"), "datetime": local, "stations": quoted("stations")}
    fields = [texts.get(c, F.coalesce(F.col(c).cast("string"), F.lit(""))) if c in texts or c in MEASURES
              else F.col(c).cast("string") for c in WEATHER_COLUMNS]
    lines = F.sort_array(F.collect_list(F.concat_ws(",", *fields)))
    header = F.array(F.lit(",".join(WEATHER_COLUMNS)))
    return values.groupBy(F.col("name").alias("location_name"), "v").agg(
        F.array_join(F.concat(header, lines), "\r\n").alias("raw_csv")
    )


def weather_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather payloads as they lie in bronze."""
    return weather_payloads(spark, sf_dir).select(
        "location_name", "raw_csv", plus_minutes(F.col("v"), 10).alias("ingested_at")
    )


def energy(spark: SparkSession, sf_dir: str, lag: int = 1) -> DataFrame:
    """What the power and carbon payloads come to, made directly: by default the last delivery of each hour."""
    given = deliveries(hourly(spark, sf_dir).filter(F.col("sk") >= CARBON_MIN), (lag,))
    estimated = F.lit(lag == 0)
    return given.select(
        "zone", F.col("h").alias("datetime"), plus_minutes(F.col("v"), 10).alias("ingested_at"),
        plus_minutes(F.col("v"), 11).alias("ingested_at_carbon"),
        estimated.alias("isEstimated_power"), estimated.alias("isEstimated_carbon"),
        *[c for c in given.columns if c.startswith(("consumption_", "production_", "import_", "export_"))],
        (F.col("n") + estimated.cast("int")).alias("consumption_total"), F.col("sk").alias("production_total"),
        F.col("hi").alias("import_total"), F.col("lo").alias("export_total"),
        F.expr("cents div n").alias("carbon_intensity"),
    ).select(*ENERGY_COLUMNS)


def weather(spark: SparkSession, sf_dir: str, lags: tuple[int, ...] = WEATHER_LAGS) -> DataFrame:
    """What the weather payloads come to, made directly."""
    values = _weather_values(hourly(spark, sf_dir), lags).withColumnRenamed("h", "datetime")
    return values.select(*WEATHER_COLUMNS, plus_minutes(F.col("v"), 10).alias("ingested_at"))
