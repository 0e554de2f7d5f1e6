"""All tables of the warehouse and the job that writes them."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions import labels
from tarmac.operators import dimensions, enrichment, facts, kpis, routes, staging
from tarmac.sources import driver_tables
from tarmac.sources.tables import layer_path, overwrite_table, write_monthly, written_once

# table -> (layer, month column, clustering columns); tables without a month are written whole
MONTHLY_TABLES = {
    "flights_enriched": ("intermediate", "flight_date", ["carrier_code", "origin_airport_code"]),
    "delay_classified": ("intermediate", "flight_date", ["carrier_code", "origin_airport_code"]),
    "fact_flights": ("marts", "flight_date", ["carrier_id", "origin_airport_id"]),
    "fact_route_monthly": ("marts", "flight_month_date", ["carrier_code"]),
}
WHOLE_TABLES = {
    "route_stats": "intermediate",
    "dim_date": "marts",
    "dim_carrier": "marts",
    "dim_airport": "marts",
    "dim_route": "marts",
    "dim_delay_cause": "marts",
    "executive_kpis": "reporting",
}
# every table after the tables it reads
WRITE_ORDER = [
    "flights_enriched", "delay_classified", "route_stats", "dim_date", "dim_carrier", "dim_airport", "dim_route",
    "dim_delay_cause", "fact_flights", "fact_route_monthly", "executive_kpis",
]


class Warehouse:
    """The tables over one set of raw tables, each built on first use."""

    def __init__(
        self, raw_flights: DataFrame, raw_airlines: DataFrame, raw_airports: DataFrame, as_of: dt.datetime,
        name: str | None = None,
    ) -> None:
        self.name = name  # what the tables were read from, if that says it all
        self.raw_flights = raw_flights
        self.raw_airlines = raw_airlines
        self.raw_airports = raw_airports
        self.as_of = as_of
        self.spark: SparkSession = raw_flights.sparkSession
        self.stored = False  # whether the tables are read from where ``write`` put them

    @classmethod
    def of_driver_tables(cls, spark: SparkSession, sf_dir: str, as_of: dt.datetime) -> Warehouse:
        return cls(
            driver_tables.raw_flights(spark, sf_dir),
            driver_tables.raw_airlines(spark, sf_dir),
            driver_tables.raw_airports(spark, sf_dir),
            as_of,
            sf_dir,
        )

    @cached_property
    def stg_flights(self) -> DataFrame:
        return staging.stage_flights(self.raw_flights)

    @cached_property
    def stg_airlines(self) -> DataFrame:
        return staging.stage_airlines(self.raw_airlines)

    @cached_property
    def stg_airports(self) -> DataFrame:
        return staging.stage_airports(self.raw_airports)

    @cached_property
    def reported_flights(self) -> DataFrame:
        """Staged flights with their COVID phase, one row each: what key figures and questions count.

        Lookups stay out, since a carrier code listed twice would multiply its flights.
        """
        return self.stg_flights.withColumn("covid_period", labels.covid_phase(F.col("flight_date")))

    @cached_property
    def lookups_in_use(self) -> tuple[DataFrame, DataFrame]:
        """Airlines and airports that flights name, each written once.

        A lookup may be far larger than the few keys in use. Written down, those are as small in Spark's statistics as
        they are, so that the wide flights are not shuffled and sorted by a handful of keys to meet them.
        """
        keys = written_once(enrichment.lookup_keys(self.stg_flights), "lookup-keys")
        return (
            written_once(enrichment.airlines_in_use(self.stg_airlines, keys), "airlines-in-use"),
            written_once(enrichment.airports_in_use(self.stg_airports, keys), "airports-in-use"),
        )

    @cached_property
    def flights_enriched(self) -> DataFrame:
        return enrichment.enrich_flights(self.stg_flights, *self.lookups_in_use)

    @cached_property
    def delay_classified(self) -> DataFrame:
        return enrichment.classify_delays(self.flights_enriched)

    @cached_property
    def operated(self) -> DataFrame:
        return routes.operated(self.flights_enriched)

    @cached_property
    def route_month_stats(self) -> DataFrame:
        return routes.route_month_stats(self.operated)

    @cached_property
    def route_months(self) -> DataFrame:
        """The route-month aggregate, written once because spine, fill and attributes all read it."""
        return written_once(self.route_month_stats, "route-months")

    @cached_property
    def route_month_spine(self) -> DataFrame:
        return routes.route_month_spine(routes.route_universe(self.route_months))

    @cached_property
    def route_month_filled(self) -> DataFrame:
        return routes.route_month_filled(
            self.route_month_spine, self.route_months, routes.calendar_month_attributes(self.route_months)
        )

    @cached_property
    def route_otp_windows(self) -> DataFrame:
        return routes.route_otp_windows(self.route_month_filled)

    @cached_property
    def route_worst_rank(self) -> DataFrame:
        return routes.route_worst_rank(self.route_month_filled)

    @cached_property
    def route_stats(self) -> DataFrame:
        return routes.route_stats(self.route_otp_windows, self.route_worst_rank)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dimensions.dim_date(self.spark, self.as_of)

    @cached_property
    def dim_carrier(self) -> DataFrame:
        return dimensions.dim_carrier(self.stg_airlines, self.as_of)

    @cached_property
    def dim_airport(self) -> DataFrame:
        return dimensions.dim_airport(self.stg_airports, self.flights_enriched)

    @cached_property
    def dim_route(self) -> DataFrame:
        return dimensions.dim_route(self.route_stats, self.as_of)

    @cached_property
    def dim_delay_cause(self) -> DataFrame:
        return dimensions.dim_delay_cause(self.spark)

    @cached_property
    def fact_flights(self) -> DataFrame:
        return facts.fact_flights(self.flights_enriched)

    @cached_property
    def fact_route_monthly(self) -> DataFrame:
        return facts.fact_route_monthly(self.route_stats, self.as_of)

    @cached_property
    def executive_kpis(self) -> DataFrame:
        return kpis.executive_kpis(self.reported_flights)

    def write(self, root: str) -> dict[str, str]:
        """Replace every table below ``root``; later tables read the written earlier ones.

        Months that are no longer in the flights leave the tables too. Staging stays a view. Returns the folder of each table.
        """
        paths = {}
        for name in WRITE_ORDER:
            if name in MONTHLY_TABLES:
                layer, month, cluster_by = MONTHLY_TABLES[name]
                path = layer_path(root, name, layer)
                write_monthly(
                    getattr(self, name), path, F.col(month), cluster_by, mode="overwrite", keep_other_months=False
                )
            else:
                path = layer_path(root, name, WHOLE_TABLES[name])
                overwrite_table(getattr(self, name), path)
            paths[name] = path
            schema = getattr(self, name).schema
            setattr(self, name, self.spark.read.schema(schema).parquet(path).select(*schema.names))
        self.stored = True
        return paths
