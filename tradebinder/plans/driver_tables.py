"""The library's tables derived from the given TPC-H-like Parquet tables.

Every derivation covers its whole source table.  Prices come from events (last record per
day and product wins), products from part, expansions from supplier, official sets from
customer, items from orders and import rows from customer.  The SQL twins of these frames
are in driver_sql.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradebinder.functions.dates import archive_name
from tradebinder.operators.keyed import newest_per_key
from tradebinder.operators.lookup import by_shuffle

RUN_TS = "2024-02-01 06:00:00"
FIRST_RUN_TS = "2024-01-25 06:00:00"


def once(method):
    """Build a frame on first use and hand out the same analyzed frame afterwards."""

    @functools.wraps(method)
    def build(self, *args):
        key = (method.__name__, *args)
        if key not in self._built:
            self._built[key] = method(self, *args)
        return self._built[key]

    return build


class DriverTables:
    """Frames over one folder of given tables; each is built when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._built: dict[tuple, DataFrame | Column] = {}

    @once
    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @once
    def price_batch(self) -> DataFrame:
        """Raw price records in record order (seq)."""
        kind, value = F.col("event_type"), F.col("value")
        product = F.col("user_id") * 14
        shift = F.get_json_object("props", "$.k").cast("bigint")
        return self.given("events").select(
            F.to_date("ts").alias("snapshot_date"),
            product.alias("id_product"),
            F.col("event_id").alias("seq"),
            F.when(kind != "signup", product % 50 + F.when(shift > 90, 2).otherwise(1)).alias("id_category"),
            F.when(kind != "error", value).alias("trend"),
            F.when(kind == "view", value * 1.2).when(~kind.isin("error", "click"), value * 0.9).alias("avg30"),
            (value * 0.5).alias("low"),
        )

    PRICE_VALUES = ["id_category", "trend", "avg30", "low"]

    @once
    def prices(self) -> DataFrame:
        return newest_per_key(
            self.price_batch(), ["snapshot_date", "id_product"], "seq", self.PRICE_VALUES
        )

    @once
    def signal_date(self) -> Column:
        """Latest snapshot date as a scalar subquery over one pruned column."""
        return self.given("events").select(F.max(F.to_date("ts"))).scalar()

    @once
    def products(self) -> DataFrame:
        group = F.when(F.col("p_type").isin("PROMO", "STANDARD", "ECONOMY"), "single").otherwise("non_single")
        seen = F.date_add(F.lit("2023-12-10").cast("date"), F.col("p_size"))
        return self.given("part").select(
            F.col("p_partkey").alias("id_product"),
            F.when(F.col("p_type") == "SMALL", F.col("p_name"))
            .otherwise(F.concat("p_name", F.lit(" #"), F.col("p_partkey").cast("string")))
            .alias("name"),
            (F.col("p_partkey") % 50 + 1).alias("id_category"),
            F.col("p_type").alias("category_name"),
            F.when(
                F.col("p_type") != "LARGE", F.floor(F.col("p_partkey") / 19.0).cast("bigint")
            ).alias("id_expansion"),
            F.col("p_size").cast("bigint").alias("id_metacard"),
            F.lit(None).cast("timestamp").alias("date_added"),
            group.alias("product_group"),
            F.when(group == "single", "products_singles_6.json")
            .otherwise("products_nonsingles_6.json")
            .alias("source_file"),
            (F.col("p_size") <= 45).alias("is_active_in_catalog"),
            (seen.cast("timestamp") + F.expr("interval 12 hours")).alias("first_seen_at"),
            F.lit(FIRST_RUN_TS).cast("timestamp").alias("last_seen_at"),
            F.lit(FIRST_RUN_TS).cast("timestamp").alias("updated_at"),
        )

    @once
    def expansions(self) -> DataFrame:
        return (
            self.given("supplier")
            .join(self.given("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.given("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("s_suppkey").alias("id_expansion"),
                F.col("s_name").alias("name_en"),
                F.concat(F.lit("DE "), "s_name").alias("name_de"),
                F.concat(F.lit("Vendor-"), F.substring("s_name", 10, 9)).alias("slug"),
                F.col("r_name").alias("series_en"),
                F.col("n_name").alias("series_de"),
                self._release("s_acctbal").alias("release_date"),
                F.floor("s_acctbal").cast("int").alias("card_count"),
                F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("set_code"),
                (F.col("s_acctbal") > 0).alias("is_active"),
            )
        )

    @staticmethod
    def _release(balance: str) -> Column:
        return F.date_add(F.lit("1999-01-01").cast("date"), F.floor(balance).cast("int"))

    @once
    def sets(self) -> DataFrame:
        """One set per customer; the market segment decides how it can be recognised."""
        digits = F.substring("c_name", 10, 9)
        segment = F.col("c_mktsegment")
        name = (
            F.when(segment == "MACHINERY", F.concat(F.lit("Supplier#"), digits))
            .when(segment == "BUILDING", F.concat("r_name", F.lit(" - SUPPLIER  "), digits))
            .when(segment == "AUTOMOBILE", F.concat(F.lit("Auto & Co "), digits))
            .when(segment == "HOUSEHOLD", F.concat(F.lit("Vendor "), digits))
            .otherwise(F.concat(F.lit("Supplier Extra "), digits))
        )
        printed = F.floor(F.abs("c_acctbal") / 50).cast("int")
        total = printed + F.col("c_nationkey") - 4
        return (
            self.given("customer")
            .join(self.given("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.given("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.concat(F.lit("set"), F.col("c_custkey").cast("string")).alias("tcg_set_id"),
                name.alias("name_en"),
                F.when(F.col("c_nationkey") != 24, F.col("r_name")).alias("series_en"),
                F.when(
                    segment == "AUTOMOBILE", F.concat(F.lit("s"), F.col("c_custkey").cast("string"))
                ).alias("ptcgo_code"),
                F.when(F.col("c_nationkey") != 0, self._release("c_acctbal")).alias("release_date"),
                printed.alias("printed_total"),
                total.alias("total_cards"),
                F.greatest(total - printed, F.lit(0)).alias("secret_card_count"),
                F.lit(None).cast("string").alias("symbol_url"),
                F.lit(None).cast("string").alias("logo_url"),
                (F.col("c_acctbal") > 0).alias("is_active"),
            )
        )

    @once
    def items(self) -> DataFrame:
        priority, status, total = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_totalprice")
        sold = status == "F"
        return self.given("orders").select(
            F.col("o_orderkey").alias("collection_item_id"),
            (
                F.floor(F.col("o_custkey") / 10.0).cast("bigint") * 14
                + F.when(priority == "5-LOW", 1).otherwise(0)
            ).alias("id_product"),
            F.when(priority == "1-URGENT", "DE").otherwise("EN").alias("language"),
            F.when(status == "P", "Near Mint").otherwise("Good").alias("condition"),
            F.when(status == "O", "bought_single").otherwise("swapped").alias("acquisition_type"),
            F.when(priority == "4-NOT SPECIFIED", F.lit(None))
            .when(total < 5000, -1.0)
            .otherwise(F.floor(total / 50) / 100.0)
            .alias("purchase_price"),
            F.to_date("o_orderdate").alias("purchase_date"),
            (priority == "2-HIGH").alias("is_sealed"),
            (priority == "1-URGENT").alias("is_graded"),
            F.when((priority == "1-URGENT") & (total > 250000), "PSA").alias("grading_company"),
            F.when((priority == "1-URGENT") & (total > 400000), "10").alias("grade"),
            F.concat(F.lit("Box "), F.substring("o_orderpriority", 1, 1)).alias("storage_location"),
            sold.alias("is_sold"),
            F.when(sold & (total > 100000), F.floor(total / 45) / 100.0)
            .when((status == "O") & (total > 490000), F.lit(-2.0))
            .alias("sold_price"),
            F.when(sold & (total > 50000), F.date_add(F.to_date("o_orderdate"), 30)).alias("sold_date"),
        )

    @once
    def staging(self) -> DataFrame:
        """Import rows as text columns, as read from an uploaded file."""
        nation, segment = F.col("c_nationkey"), F.col("c_mktsegment")
        names = self.products().select(F.col("id_product").alias("c_custkey"), F.col("name").alias("_name"))
        rows = self.given("customer").join(by_shuffle(names), "c_custkey", "left")
        return rows.select(
            F.col("c_custkey").alias("import_row_id"),
            segment.alias("import_batch_id"),
            F.col("c_custkey").alias("record_index"),
            F.when(nation > 15, F.concat(F.lit("ext-"), F.floor(F.col("c_acctbal") / 100).cast("string"))).alias(
                "external_id"
            ),
            F.when(nation < 8, (F.col("c_custkey") * 2).cast("string")).alias("provided_id_product"),
            F.when(nation == 9, "no such product").when(nation != 10, F.col("_name")).alias("raw_product_name"),
            F.when(nation == 5, "XX").when(nation != 11, "EN").alias("language"),
            F.when(nation == 6, "Fresh").otherwise("Near Mint").alias("condition"),
            F.when(segment == "MACHINERY", "gift").alias("acquisition_type"),
            F.when(nation == 12, "four").when(nation != 13, F.floor("c_acctbal").cast("string")).alias("purchase_price"),
            F.when(nation == 14, "2024-13-01").otherwise("2024-01-15").alias("purchase_date"),
            F.when(nation == 15, "true").alias("is_sealed"),
            F.lit(None).cast("string").alias("storage_location"),
            F.lit(None).cast("string").alias("personal_note"),
        )

    @once
    def imported(self) -> DataFrame:
        """External ids of earlier imports."""
        return self.given("supplier").select(
            F.concat(F.lit("ext-"), F.floor(F.col("s_acctbal") / 100).cast("string")).alias("external_id")
        )

    @once
    def watchlist(self) -> DataFrame:
        return self.given("supplier").select(
            F.col("s_suppkey").alias("watchlist_item_id"),
            (F.floor(F.col("s_suppkey") * 1.5).cast("bigint") * 14).alias("id_product"),
            F.col("s_name").alias("reason"),
            (F.col("s_acctbal") / 100).alias("target_price"),
            (F.col("s_acctbal") > 0).alias("is_active"),
        )

    @once
    def listing(self) -> DataFrame:
        """Archive folder with one prefix per user: an upload per hour with events."""
        hour = F.hour("ts")
        name = archive_name(
            F.concat(F.lit("guide_"), F.col("user_id").cast("string")), F.to_date("ts"), F.nullif(hour, F.lit(0))
        )
        return self.given("events").select(name.alias("file_name")).distinct()

    @once
    def catalog(self) -> DataFrame:
        """The current catalog run: every part of size 15 and up, with refreshed names."""
        return self.products().filter("id_metacard >= 15").select(
            "id_product",
            F.concat("name", F.lit(" v2")).alias("name"),
            "id_category", "category_name", "id_expansion", "id_metacard", "date_added",
            "product_group", "source_file",
            F.col("id_product").alias("record_index"),
        )

    @once
    def known_products(self) -> DataFrame:
        """The product table before the run: every part up to size 35."""
        return self.products().filter("id_metacard <= 35")

    @once
    def documents(self) -> DataFrame:
        """Price-guide documents as JSON text, one per event."""
        value = F.col("value")
        record = F.struct(
            (F.col("user_id") * 14).alias("idProduct"),
            F.get_json_object("props", "$.k").cast("int").alias("idCategory"),
            F.when(F.col("event_type") != "error", value).alias("trend"),
            F.when(~F.col("event_type").isin("error", "click"), F.round(value * 0.9, 4)).alias("avg30"),
            F.when(F.col("event_type") == "view", F.lit(0)).alias("trend-holo"),
        )
        root = F.struct(
            F.lit(1).alias("version"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+0200'").alias("createdAt"),
            F.array(record).alias("priceGuides"),
        )
        name = archive_name(
            F.concat(F.lit("guide_"), F.col("user_id").cast("string")), F.to_date("ts"), F.col("event_id") + 1
        )
        return self.given("events").select(name.alias("file_name"), F.to_json(root).alias("content"))

    @once
    def raw_expansions(self) -> DataFrame:
        """Curated expansion file as text cells, with blanks and loose spellings."""
        nation, number = F.col("s_nationkey"), F.col("s_suppkey").cast("string")
        return self.given("supplier").select(
            (F.col("s_suppkey") + 2).alias("line_number"),
            F.concat(F.lit(" "), number, F.lit(" ")).alias("id_expansion"),
            F.concat(F.lit("\t"), "s_name", F.lit(" ")).alias("name_en"),
            F.when(nation == 3, "  ").otherwise(F.col("s_name")).alias("name_de"),
            F.when(nation == 4, "").otherwise(F.concat(F.lit("V-"), number)).alias("slug"),
            F.when(nation == 5, " ").otherwise(F.concat(F.lit("2020-01-"), F.lpad((nation + 1).cast("string"), 2, "0"))).alias(
                "release_date"
            ),
            F.when(nation == 6, "")
            .otherwise(F.concat(F.lit(" "), F.floor(F.abs("s_acctbal")).cast("string")))
            .alias("card_count"),
            F.when(nation == 0, "yes")
            .when(nation == 1, "NO")
            .when(nation == 2, " 0 ")
            .when(nation == 3, "maybe")
            .when(nation == 4, "")
            .when(nation != 5, "true")
            .alias("is_active"),
        )

    @once
    def catalog_files(self) -> DataFrame:
        """Catalog documents, one per part; the root and the field names depend on its type."""
        kind, size = F.col("p_type"), F.col("p_size")
        name = F.when(size == 2, "").when(size != 1, F.col("p_name"))
        category = F.when(size == 3, "").otherwise(F.col("p_partkey").cast("string"))
        expansion = F.floor(F.col("p_partkey") / 19.0).cast("bigint")
        usual = F.to_json(
            F.struct(
                F.col("p_partkey").alias("idProduct"), name.alias("name"), category.alias("idCategory"),
                kind.alias("categoryName"), expansion.alias("idExpansion"), size.alias("idMetacard"),
                F.when(size == 4, "soon").otherwise("2024-01-02 03:04:05").alias("dateAdded"),
            )
        )
        other = F.to_json(
            F.struct(F.col("p_partkey").alias("productId"), name.alias("Name"), expansion.alias("expansionId"))
        )
        content = (
            F.when(kind == "STANDARD", F.concat(F.lit("["), usual, F.lit("]")))
            .when(kind == "PROMO", F.concat(F.lit('{"products":['), usual, F.lit("]}")))
            .when(kind == "ECONOMY", F.concat(F.lit('{"data":['), usual, F.lit("]}")))
            .when(kind == "SMALL", F.concat(F.lit('{"products":"none","items":['), usual, F.lit("]}")))
            .when(kind == "MEDIUM", F.concat(F.lit('{"productList":['), usual, F.lit("]}")))
            .otherwise(F.concat(F.lit('{"meta":{"a":1},"stuff":['), other, F.lit("]}")))
        )
        name_of_file = F.concat(F.lit("products_"), F.lower("p_type"), F.lit("_6_"), F.col("p_partkey").cast("string"))
        return self.given("part").select(name_of_file.alias("file_name"), content.alias("content"))

    @once
    def set_files(self) -> DataFrame:
        """Set documents, one per customer."""
        nation = F.col("c_nationkey")
        printed = F.floor(F.abs("c_acctbal") / 50).cast("int")
        legal = F.when(nation > 9, F.create_map(F.lit("standard"), F.lit("Legal")))
        record = F.struct(
            F.concat(F.lit("set"), F.col("c_custkey").cast("string")).alias("id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("series"),
            F.when(nation != 1, printed).alias("printedTotal"),
            (printed + nation - 4).alias("total"),
            legal.alias("legalities"),
            F.when(nation != 2, F.concat(F.lit("C"), F.col("c_custkey").cast("string"))).alias("ptcgoCode"),
            F.when(nation == 3, "").otherwise(F.date_format(self._release("c_acctbal"), "yyyy/MM/dd")).alias("releaseDate"),
            F.date_format(self._release("c_acctbal"), "yyyy/MM/dd 13:45:00").alias("updatedAt"),
            F.when(nation != 4, F.struct(F.lit("sym").alias("symbol"), F.col("c_name").alias("logo"))).alias("images"),
        )
        return self.given("customer").select(
            F.col("c_name").alias("file_name"), F.to_json(F.array(record)).alias("content")
        )

    @once
    def upload(self) -> DataFrame:
        """An uploaded collection file: five of the known columns, as text."""
        nation = F.col("c_nationkey")
        return self.given("customer").select(
            F.col("c_custkey").alias("record_index"),
            F.when(nation == 1, " ").otherwise(F.col("c_name")).alias("externalId"),
            F.when(nation < 12, (F.col("c_custkey") * 2).cast("string")).alias("providedIdProduct"),
            F.col("c_mktsegment").alias("rawProductName"),
            F.when(nation == 2, "").when(nation != 3, "FR").alias("language"),
            F.when(nation != 4, F.floor("c_acctbal").cast("string")).alias("purchasePrice"),
        )

    @once
    def card_pages(self) -> DataFrame:
        """The pages with a card suffix behind every link text."""
        suffix = F.concat(F.lit(" (PG"), F.col("page_id").cast("string"), F.lit(" 7/9) new</a>"))
        return self.given("pages").withColumn("html", F.replace("html", F.lit("</a>"), suffix))
