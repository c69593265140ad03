"""Raw CSV and archive readers, Parquet sinks and their layouts."""

import glob
import os
import zipfile

import pyarrow.parquet as pq
import pytest
from flightlines import write_csv
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac import schema as S
from tarmac.operators import clean as C
from tarmac.operators import intake
from tarmac.sources import archives, clustering, footers, parquet, raw_csv

LINES = ["HA/118 HNL-OGG 2021-07-04 dep=3 arr=x in=0758", "AS/7 SEA-HNL 2021-07-05", "/7 SEA-HNL 2021-07-06 off=1 why=B"]


def zipped(path, *members):
    """A zip of (name, file path) members."""
    with zipfile.ZipFile(path, "w") as z:
        for name, file in members:
            z.write(file, arcname=name)
    return path


class TestRawReaders:
    @pytest.mark.parametrize("extra, tail", [([], ""), (["Tail"], ""), ([], ","), (["Tail", "Gate"], ",,")])
    def test_both_readers_give_the_same_rows(self, spark, scratch, extra, tail):
        columns = [*extra, *sorted(S.RAW_COLUMNS)]
        file = write_csv(f"{scratch}/m.csv", LINES, columns, tail)
        zipped(f"{scratch}/m.zip", ("m.csv", file))
        plain = raw_csv.read_raw(spark, file)
        packed = archives.read_archives(spark, f"{scratch}/m.zip", chunk_rows=2)
        assert plain.columns == packed.columns == S.RAW_COLUMNS
        rows = sorted(map(tuple, plain.collect()), key=str)
        assert rows == sorted(map(tuple, packed.collect()), key=str)
        assert [r["Dest"] for r in plain.orderBy("FlightDate").collect()] == ["OGG", "HNL", "HNL"]
        assert C.clean(packed).count() == 2

    def test_short_and_blank_lines_do_not_shift(self, spark, scratch):
        file = write_csv(f"{scratch}/m.csv", LINES)
        with open(file, "a") as out:
            out.write("2021-07-09,HA\n\n")
        zipped(f"{scratch}/m.zip", ("m.csv", file))
        packed = archives.read_archives(spark, f"{scratch}/m.zip").filter("FlightDate = '2021-07-09'").collect()
        assert [(r["Reporting_Airline"], r["Dest"]) for r in packed] == [("HA", None)]

    def test_every_member_of_an_archive_is_read(self, spark, scratch):
        one, two = write_csv(f"{scratch}/1.csv", LINES[:1]), write_csv(f"{scratch}/2.csv", LINES[1:], S.RAW_COLUMNS[::-1])
        notes = f"{scratch}/readme.txt"
        open(notes, "w").write("not data")
        zipped(f"{scratch}/m.zip", ("readme.txt", notes), ("a.csv", one), ("deep/B.CSV", two))
        assert archives.read_archives(spark, f"{scratch}/m.zip").count() == 3

    def test_every_member_is_a_task_and_only_asked_columns_are_cut(self, spark, scratch):
        os.makedirs(f"{scratch}/z")
        files = [write_csv(f"{scratch}/{k}.csv", LINES * (k + 1)) for k in range(12)]
        zipped(f"{scratch}/z/year.zip", *[(f"{k:02d}.csv", f) for k, f in enumerate(files)])
        got = archives.read_archives(spark, f"{scratch}/z", columns=["Dest", "FlightDate"])
        assert got.columns == ["Dest", "FlightDate"] and got.rdd.getNumPartitions() == 12
        tasks = got.groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert sorted(r["count"] for r in tasks) == [3 * (k + 1) for k in range(12)]

    def test_a_bad_byte_is_a_reason_not_a_failure(self, spark, scratch):
        file = write_csv(f"{scratch}/m.csv", LINES[:2])
        data = open(file, "rb").read().replace(b"OGG", b"O\xffG")
        open(file, "wb").write(data.rstrip(b"\n") + b"\n")
        zipped(f"{scratch}/m.zip", ("m.csv", file))
        packed = archives.read_archives(spark, f"{scratch}/m.zip")
        assert sorted(map(tuple, packed.collect()), key=str) == sorted(map(tuple, raw_csv.read_raw(spark, file).collect()), key=str)
        reasons = {r["dest"]: r["reasons"] for r in intake.tag(packed).collect()}
        assert reasons == {"O\ufffdG": "undecodable:dest,malformed:arr_delay", "HNL": None}
        with pytest.raises(Exception, match="decode"):
            archives.read_archives(spark, f"{scratch}/m.zip", decode="strict").collect()

    def test_a_very_long_cell_is_read(self, spark, scratch):
        file = write_csv(f"{scratch}/m.csv", LINES[1:2])
        open(file, "a").write("x" * 300_000 + ",HA\n")
        zipped(f"{scratch}/m.zip", ("m.csv", file))
        assert archives.read_archives(spark, f"{scratch}/m.zip").count() == 2

    def test_missing_column_or_member_fails(self, spark, scratch):
        file = write_csv(f"{scratch}/m.csv", LINES, S.RAW_COLUMNS[:-1])
        with pytest.raises(ValueError, match="ArrTime"):
            raw_csv.read_raw(spark, file)
        os.makedirs(f"{scratch}/a")
        zipped(f"{scratch}/a/m.zip", ("m.csv", file))
        with pytest.raises(Exception, match="ArrTime"):
            archives.read_archives(spark, f"{scratch}/a").collect()
        os.makedirs(f"{scratch}/b")
        zipped(f"{scratch}/b/m.zip", ("m.txt", file))
        with pytest.raises(Exception, match="No CSV found"):
            archives.read_archives(spark, f"{scratch}/b").collect()

    def test_store_schemes_are_known_to_arrow(self):
        assert archives.ARROW_SCHEMES["s3a"] == "s3" and archives.ARROW_SCHEMES["wasbs"] == "abfss"


class TestParquetSinks:
    def _clean(self, flights, *dates, arr="30.0"):
        return C.clean(flights(*[f"HA/118 HNL-OGG {d} arr={arr}" for d in dates]))

    def test_partitioned_layout_and_schema(self, flights, scratch):
        out = f"{scratch}/clean"
        parquet.write_clean(self._clean(flights, "2024-01-15", "2024-02-01"), out)
        assert [d for d in sorted(os.listdir(out)) if not d.startswith(("_", "."))] == ["year=2024"]
        assert sorted(os.listdir(f"{out}/year=2024")) == ["month=1", "month=2"]

    def test_dynamic_overwrite_replaces_only_its_month(self, flights, spark, scratch):
        out = f"{scratch}/clean"
        parquet.write_clean(self._clean(flights, "2024-01-15", "2024-02-01"), out)
        parquet.write_clean(self._clean(flights, "2024-02-09", "2024-02-10", arr="5"), out)
        got = sorted((r["month"], r["arr_delay"]) for r in spark.read.parquet(out).collect())
        assert got == [(1, 30.0), (2, 5.0), (2, 5.0)]

    def test_truncate_mode_replaces_all(self, flights, spark, scratch):
        out = f"{scratch}/clean"
        parquet.write_clean(self._clean(flights, "2024-01-15"), out)
        parquet.write_clean(self._clean(flights, "2024-02-09"), out, mode="truncate")
        assert [r["month"] for r in spark.read.parquet(out).collect()] == [2]

    def test_salted_write(self, flights, spark, scratch):
        out = f"{scratch}/clean"
        parquet.write_clean(self._clean(flights, *["2024-01-15"] * 6), out, salt_buckets=3)
        assert spark.read.parquet(out).count() == 6

    def test_hot_month_is_split_without_salt(self, spark, scratch):
        # One month holds a third of all rows. The default layout (a REBALANCE
        # on the month keys) lets adaptive execution split that month across
        # several write tasks instead of sending it whole to one.
        rows = spark.range(60000).select(
            F.lit(2000).alias("year"),
            F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 11 + 2).alias("month"),
            F.lit("AA").alias("mkt_carrier"),
            F.lit("LAX").alias("origin"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
        before = spark.conf.get(key)
        spark.conf.set(key, "256k")
        try:
            out = f"{scratch}/clean"
            parquet.write_clean(rows, out)
        finally:
            spark.conf.set(key, before)
        hot = [f for f in os.listdir(f"{out}/year=2000/month=1") if f.endswith(".parquet")]
        assert len(hot) > 1
        back = spark.read.parquet(out)
        assert back.count() == 60000
        assert back.filter("month = 1").count() == 20000

    def test_layout_without_adaptive_execution(self, flights, spark, scratch):
        out = f"{scratch}/clean"
        rows = self._clean(flights, *["2024-01-15", "2024-02-01"] * 40).repartition(16)
        key = "spark.sql.adaptive.enabled"
        spark.conf.set(key, "false")
        try:
            parquet.write_clean(rows, out)
        finally:
            spark.conf.set(key, "true")
        files = [f for f in os.listdir(f"{out}/year=2024/month=1") if f.endswith(".parquet")]
        assert len(files) <= parquet.PLAIN_SALT_BUCKETS
        assert spark.read.parquet(out).count() == 80

    def test_load_staging_conforms(self, flights, spark, scratch):
        parquet.write_clean(self._clean(flights, "2024-01-15"), f"{scratch}/clean")
        table = parquet.load_staging(spark, f"{scratch}/clean", f"{scratch}/raw_flights")
        assert set(table.columns) == {f.name for f in S.STAGING_SOURCE_SCHEMA.fields}
        assert table.count() == 1

    def test_a_drifted_file_is_named_and_refused(self, flights, spark, scratch):
        parquet.write_clean(self._clean(flights, "2024-01-15"), f"{scratch}/clean")
        table = parquet.load_staging(spark, f"{scratch}/clean", f"{scratch}/raw_flights")
        before = sorted(map(str, table.collect()))
        month = f"{scratch}/clean/year=2024/month=2"
        good = self._clean(flights, "2024-02-01", arr="7").drop("year", "month")
        good.withColumn("arr_delay", F.col("arr_delay").cast("string")).withColumn("distance", F.lit(3).cast("smallint")).coalesce(1).write.parquet(month)
        good.drop("origin").coalesce(1).write.mode("append").parquet(month)
        with pytest.raises(footers.DriftedSchema) as caught:
            parquet.load_staging(spark, f"{scratch}/clean", f"{scratch}/raw_flights")
        kinds = {(column, declared, stored, files) for column, declared, stored, files, _ in caught.value.drifts}
        assert kinds == {("arr_delay", "float", "string", 1), ("origin", "string", "missing", 1)}  # a short distance widens
        assert all("/month=2/" in example for *_, example in caught.value.drifts)
        assert sorted(map(str, spark.read.schema(table.schema).parquet(f"{scratch}/raw_flights").collect())) == before

    def test_widening_and_empty_folders_fit(self, spark, scratch):
        assert footers.fits(T.DoubleType(), "float") and footers.fits(T.LongType(), "int")
        assert not footers.fits(T.FloatType(), "double") and not footers.fits(T.StringType(), "int")
        os.makedirs(f"{scratch}/none")
        footers.check(spark, f"{scratch}/none", S.STAGING_SOURCE_SCHEMA)

    def test_conform_missing_column(self, spark):
        with pytest.raises(ValueError):
            parquet.conform(spark.range(1), S.STAGING_SOURCE_SCHEMA)

    def test_between_dates_prunes_partitions(self, flights, spark, scratch):
        out = f"{scratch}/clean"
        parquet.write_clean(self._clean(flights, "2024-01-15", "2024-02-01", "2024-03-31", "2024-05-01"), out)
        df = parquet.between_dates(spark.read.parquet(out), "2024-02-01", "2024-03-31")
        assert df.count() == 2
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]

    def test_materialize_cuts_lineage(self, flights, spark, scratch):
        out = parquet.materialize(self._clean(flights, "2024-01-15"), f"{scratch}/t")
        assert out.count() == 1
        assert "FileScan parquet" in out._jdf.queryExecution().executedPlan().toString()

    def test_view(self, flights):
        v = parquet.as_view(self._clean(flights, "2024-01-15"), "stg_view_test")
        assert v.sparkSession.sql("select count(*) from stg_view_test").first()[0] == 1

    def test_written_tables_keep_declared_types(self, flights, spark, scratch):
        out = f"{scratch}/t"
        df = self._clean(flights, "2024-01-15").withColumn("year", F.col("year").cast("bigint"))
        parquet.write_partitioned(df, out, ["year", "month"], [])
        assert dict(parquet.read_table(spark, out, df.schema).dtypes)["year"] == "bigint"
        assert parquet.read_table(spark, f"{scratch}/none", df.schema).count() == 0
        assert parquet.partition_values(spark, out, ["year", "month"]) == [(2024, 1)]

    def test_catalog_table_by_name(self, flights, spark, scratch):
        out = f"{scratch}/named"
        df = self._clean(flights, "2024-01-15", "2024-02-01")
        parquet.write_clean(df, out)
        table = parquet.as_table(df, "named_clean_test", out, partition_by=["year", "month"])
        assert table.count() == 2
        parquet.write_clean(self._clean(flights, "2024-03-01"), out)
        assert parquet.as_table(df, "named_clean_test", out, partition_by=["year", "month"]).count() == 3
        assert spark.table("named_clean_test").filter("month = 3").count() == 1
        spark.sql("DROP TABLE named_clean_test")


class TestCurve:
    """Rows along a space-filling curve of carrier and origin."""

    CARRIERS = [f"C{k:02d}" for k in range(16)]
    AIRPORTS = [f"A{k:02d}" for k in range(32)]

    def _rows(self, spark, n=40000):
        carrier = F.array(*map(F.lit, self.CARRIERS))[(F.xxhash64("id") % 16 + 16).cast("int") % 16]
        origin = F.array(*map(F.lit, self.AIRPORTS))[(F.xxhash64("id", F.lit(1)) % 32 + 32).cast("int") % 32]
        return spark.range(n).select(
            F.lit(2024).alias("flight_year"), F.lit(1).alias("flight_month"), F.col("id"),
            carrier.alias("carrier_code"), origin.alias("origin_airport"), F.md5(F.col("id").cast("string")).alias("pad"),
        )

    @staticmethod
    def _groups(path, column, value):
        """(row groups that may hold ``column = value``, all row groups), by the footers."""
        hit = total = 0
        for name in glob.glob(f"{path}/**/*.parquet", recursive=True):
            meta = pq.ParquetFile(name).metadata
            at = meta.schema.names.index(column)
            for g in range(meta.num_row_groups):
                stats = meta.row_group(g).column(at).statistics
                total += 1
                hit += stats.min <= value <= stats.max
        return hit, total

    def test_a_filter_on_the_second_column_skips_row_groups(self, spark, scratch):
        rows = self._rows(spark)
        by = dict(partition_by=["flight_year", "flight_month"], cluster_by=["carrier_code", "origin_airport"])
        spark.conf.set("spark.sql.adaptive.enabled", "false")  # as many files on either side
        try:
            with_old = spark.conf.get("spark.sql.shuffle.partitions")
            spark.conf.set("spark.sql.shuffle.partitions", "16")
            parquet.write_partitioned(rows, f"{scratch}/sorted", **by, salt_buckets=16)
            clustering.write_curved(rows, f"{scratch}/curved", **by)
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
            spark.conf.set("spark.sql.shuffle.partitions", with_old)
        order = ["id", "carrier_code", "origin_airport", "pad"]
        key = lambda p: sorted(map(tuple, spark.read.parquet(p).select(*order).collect()))
        assert key(f"{scratch}/curved") == key(f"{scratch}/sorted")
        for column, value in (("origin_airport", "A07"), ("carrier_code", "C05")):
            hit, total = self._groups(f"{scratch}/curved", column, value)
            before, all_before = self._groups(f"{scratch}/sorted", column, value)
            assert hit / total <= 0.5 and hit / total < before / all_before

    def test_places_follow_both_columns_and_nulls_come_first(self, spark):
        rows = spark.createDataFrame(
            [(c, o) for c in ("A", "B", "C", "D") for o in (1, 2, 3, 4)] + [(None, None)], "c string, o int"
        )
        borders = clustering.cell_borders(rows, ["c", "o"], bits=2)
        got = {(r["c"], r["o"]): r["place"] for r in rows.withColumn("place", clustering.curve(rows, ["c", "o"], borders, 2)).collect()}
        assert got[None, None] == min(got.values())
        for o in (1, 2, 3, 4):
            assert [got[c, o] for c in "ABCD"] == sorted(got[c, o] for c in "ABCD")
        for c in "ABCD":
            assert [got[c, o] for o in (1, 2, 3, 4)] == sorted(got[c, o] for o in (1, 2, 3, 4))
        assert got["D", 4] == max(got.values()) and len(set(got.values())) > 8
        assert got["A", 4] < got["D", 4] and got["D", 1] < got["D", 4]

    def test_other_months_stay_and_an_odd_table_is_written(self, spark, scratch):
        out = f"{scratch}/t"
        rows = self._rows(spark, 200)
        clustering.write_fact_curved(rows, out)
        later = rows.limit(5).withColumn("flight_month", F.lit(2)).withColumn("_place", F.lit("x")).drop("pad")
        clustering.write_curved(later, out, ["flight_year", "flight_month"], ["carrier_code", "origin_airport"])
        clustering.write_fact_curved(rows.limit(0), out)
        hot = rows.withColumn("flight_month", F.lit(3)).withColumn("carrier_code", F.lit(None).cast("string"))
        clustering.write_fact_curved(hot, out)
        counts = {r[0]: r[1] for r in spark.read.parquet(out).groupBy("flight_month").count().collect()}
        assert counts == {1: 200, 2: 5, 3: 200}
        with pytest.raises(ValueError, match="cannot be laid out"):
            clustering.cell_borders(rows.withColumn("m", F.array("id")), ["m"])
