"""Domain inputs derived from the driver tables (FIXTURES.md, section 3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelstats.reference_data import SPECIAL_COMPLEXES

ZONES = [11, 14, 21, 23, 26, 31, 38, 39, 43, 45, 49, 51, 60]


class Inputs:
    """The domain inputs of one driver folder, built on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            self.tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self.tables[name]

    def parcel_key(self) -> DataFrame:
        complex_no = F.floor(F.col("p_partkey") / 4)
        zone = F.element_at(F.array(*[F.lit(z) for z in ZONES]), (complex_no % 13 + 1).cast("int"))
        return self.table("part").select(
            "p_partkey",
            complex_no.alias("cplx"),
            (F.col("p_partkey") % 4).alias("unit"),
            zone.cast("bigint").alias("zs"),
            "p_size",
            "p_retailprice",
        )

    def assessments(self) -> DataFrame:
        size = F.col("p_size")
        building = F.floor(F.col("p_retailprice") * 1000)
        land = F.floor(F.col("p_retailprice") * 500)
        exemption = (size * 1000).cast("bigint")
        tax_class = F.element_at(
            F.array(
                *map(
                    F.lit,
                    [
                        "owner-occupied",
                        "non-owner-occupied",
                        "tvr-strh",
                        "long-term-rental",
                        "owner-occupied",
                        "commercial",
                    ],
                )
            ),
            size % 6 + 1,
        )
        part = F.col("p_partkey")
        one = F.lit(1).cast("bigint")

        def row(key: Column, label: Column, *values: Column) -> Column:
            names = ["assessed_building_value", "assessed_land_value", "building_exemption"]
            columns = [v.cast("bigint").alias(n) for v, n in zip(values, names)]
            return F.struct(key.cast("bigint").alias("tmk"), label.alias("tax_rate_class"), *columns)

        main = row(_tmk(), tax_class, F.when(part % 10 == 0, 0).otherwise(building), land, exemption)
        second = row(_tmk(), F.lit("non-owner-occupied"), building, land, exemption)
        broken = row(part, F.lit("owner-occupied"), one, one, one)
        rows = F.array(main, F.when(part % 97 == 0, second), F.when(part % 101 == 0, broken))
        return (
            self.parcel_key()
            .select(F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("row"))
            .select("row.*")
        )

    def prior_assessments(self) -> DataFrame:
        """Values of the year before; some keys gained a digit and are not valid."""
        tmk = F.col("tmk")
        return self.assessments().select(
            F.when(tmk % 9 == 0, tmk * 10 + 1).otherwise(tmk).alias("tmk"),
            (F.col("assessed_building_value") + 1000).alias("assessed_building_value"),
            "assessed_land_value",
            "building_exemption",
        )

    def dwellings(self) -> DataFrame:
        order = F.col("l_orderkey")
        orphan = F.when(F.col("p_partkey") % 11 == 0, 5000).otherwise(0)
        cards = self.table("lineitem").join(
            self.parcel_key(), F.col("l_partkey") == F.col("p_partkey")
        )
        return cards.select(
            (_tmk() + orphan).cast("bigint").alias("tmk"),
            F.when(order % 101 == 0, 100)
            .otherwise(200 + F.col("l_quantity") * 40)
            .cast("bigint")
            .alias("sf_of_living_area"),
            (order % 70 + 1960).alias("year_built"),
            ((order + F.col("l_linenumber")) % 5).alias("bed_rooms"),
            F.when(order % 41 != 0, F.col("cplx") % 3).alias("condo_type"),
        )

    def owners(self) -> DataFrame:
        nation = F.col("c_nationkey")
        first = F.when(nation < 6, 96753).when(nation != 7, nation + 90000)
        both = F.array(first, 80000 + nation)
        zips = F.when(F.col("c_custkey") % 5 == 0, both).otherwise(F.array(first))
        parcels = self.table("customer").join(
            self.parcel_key(), F.col("c_custkey") == F.col("p_partkey")
        )
        return parcels.select(
            _tmk().cast("bigint").alias("tmk"),
            F.explode(zips.cast("array<bigint>")).alias("mailing_zip1"),
        )

    def sales(self) -> DataFrame:
        order = F.col("o_orderkey")
        day = F.date_format("o_orderdate", "yyyy-MM-dd")
        buyer = F.col("o_custkey")
        parcels = F.when(order % 20 == 0, F.array(buyer, buyer + 1)).otherwise(F.array(buyer))
        recorded = self.table("orders").withColumn("pk", F.explode(parcels))
        key = F.col("zs") * 10000000000 + F.col("cplx") * 10000 + F.col("unit")
        return recorded.join(self.parcel_key(), F.col("pk") == F.col("p_partkey")).select(
            key.cast("bigint").alias("parid"),
            F.when(order % 53 == 0, None)
            .when(order % 50 == 0, "1900-01-01")
            .otherwise(day)
            .alias("saledate"),
            day.alias("recorddate"),
            F.floor("o_totalprice").alias("price"),
            F.col("o_orderpriority").alias("instruno"),
            F.when(order % 3 != 0, order.cast("string")).alias("landcourt_no"),
            (order % 7).cast("string").alias("cert_no"),
        )

    def special_complexes(self) -> DataFrame:
        return (
            self.parcel_key()
            .filter(F.col("p_size") <= 10)
            .select((F.col("zs") * 1000000 + F.col("cplx")).alias("tmk_sub"))
            .distinct()
        )

    def in_built_in_complexes(self, parcels: DataFrame) -> DataFrame:
        """Two parcels in three move to one of the built-in complexes, whole complexes at a time."""
        codes = F.array(*[F.lit(code) for code in sorted(SPECIAL_COMPLEXES)])
        sub = F.expr("tmk div 10000 % 100000000")
        code = F.element_at(codes, (sub % len(SPECIAL_COMPLEXES) + 1).cast("int")).cast("bigint")
        moved = 2000000000000 + code * 10000 + F.col("tmk") % 10000
        inside = F.expr("length(cast(tmk AS string)) = 13") & (sub % 3 != 0)
        return parcels.withColumn("tmk", F.when(inside, moved).otherwise(F.col("tmk")))

    def tract_income(self) -> DataFrame:
        customer, nation = F.col("c_custkey"), F.col("c_nationkey")
        years = ["1980", "1990", "2000", "2006-2010", "2011-2015", "2016-2020"]
        income = 20000 + F.floor(F.col("c_acctbal") * 5) + customer % 1000
        return self.table("customer").select(
            _pick(years, customer).alias("year"),
            F.when((nation == 3) & (customer % 7 == 0), "Alaska").otherwise("Hawaii").alias("state"),
            _tract().alias("tracta"),
            F.when(customer % 37 != 0, income.cast("int")).alias("b79aa"),
        )

    def tract_population(self) -> DataFrame:
        customer = F.col("c_custkey")
        return (
            self.table("customer")
            .groupBy(
                _pick(["1980", "1990", "2000", "2010", "2020"], customer).alias("year"),
                F.when(F.col("c_nationkey") == 10, "Alaska").otherwise("Hawaii").alias("state"),
                _tract().alias("tracta"),
            )
            .agg(F.sum(100 + customer % 400).cast("int").alias("av0aa"))
        )

    def county_income(self) -> DataFrame:
        county = F.when(F.col("tracta") % 4 == 0, "Maui County").otherwise("Kauai County")
        return (
            self.tract_income()
            .groupBy("year", "state", county.alias("county"))
            .agg(F.max("b79aa").alias("b79aa"))
        )

    def year_index(self) -> DataFrame:
        regions = self.table("region").select(F.col("r_regionkey").alias("r"))
        numbered = self.table("nation").withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(4))))
        index = (F.col("n_nationkey") + 25 * F.col("r")).cast("bigint")
        return numbered.join(regions, "r").select(index.alias("i"))

    def cpi(self) -> DataFrame:
        i = F.col("i")
        return self.year_index().select(
            (1980 + i).alias("year"), (80 + i * 4 + i % 5).cast("double").alias("cpi")
        )

    def state_reference(self) -> DataFrame:
        i = F.col("i")
        income = 25000 + i * 1500 + (i % 4) * 250
        return self.year_index().select(
            F.concat((1984 + i).cast("string"), F.lit("-01-01")).alias("observation_date"),
            income.cast("string").alias("median_household_income"),
        )

    def county_reference(self) -> DataFrame:
        i = F.col("i")
        income = 31000 + i * 1450 + (i % 3) * 400
        return self.year_index().select(
            F.concat((1989 + i).cast("string"), F.lit("-01-01")).alias("observation_date"),
            F.when((i % 3 == 0) & (i < 11), ".")
            .otherwise(income.cast("string"))
            .alias("median_household_income"),
        )


def _tmk() -> Column:
    return F.lit(2000000000000) + F.col("zs") * 10000000000 + F.col("cplx") * 10000 + F.col("unit")


def _tract() -> Column:
    return 30000 + (F.col("c_nationkey") + 1) * 100 + F.col("c_custkey") % 4


def _pick(values: list[str], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values) + 1).cast("int"))
