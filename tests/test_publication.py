"""Publication by manifest, rejected candidates, mergeable metric state."""

import glob

import pytest
from pyspark.sql import functions as F

from picsel.operators import manifest as Mf
from picsel.operators import metrics as E
from picsel.operators import rejects as R
from picsel.sources.standins import MONTH, StandIns
from conftest import SF_SMALL, same_rows

PARTS = ["wiki", "snapshot"]


def _rows(spark, n, tag, wikis=("enwiki", "frwiki", "kowiki")):
    rows = spark.range(n).select(F.col("id").cast("string").alias("page_id"), F.concat(F.lit(tag), F.col("id")).alias("page_title"), F.array(F.lit(tag)).alias("found_on"),
                                 F.explode(F.array(*[F.lit(w) for w in wikis])).alias("wiki"), F.lit("2021-01").alias("snapshot"))
    return rows


def test_publications_replace_their_partitions(spark, scratch):
    first, second = _rows(spark, 50, "a"), _rows(spark, 7, "b", ("frwiki",))
    assert Mf.current_version(spark, scratch) == 0 and Mf.read(spark, scratch, first.schema).count() == 0
    assert Mf.publish(first, scratch, PARTS, ["page_id"], [F.col("page_title").desc()], rows_per_file=20) == 1
    assert Mf.manifest(spark, scratch).agg(F.sum("n_rows"), F.count_distinct("partition.wiki")).first()[:] == (150, 3)
    assert same_rows(Mf.read(spark, scratch, first.schema), first)
    assert Mf.publish(second, scratch, PARTS, ["page_id"]) == 2
    assert same_rows(Mf.read(spark, scratch, first.schema), first.where("wiki <> 'frwiki'").union(second))
    assert same_rows(Mf.read(spark, scratch, first.schema, version=1), first)  # the old publication is still whole
    assert Mf.publish(first.limit(0), scratch, PARTS, ["page_id"]) == 2
    assert Mf.damaged(spark, scratch, first.schema, PARTS).count() == 0


def test_null_partition_values(spark, scratch):
    rows = _rows(spark, 5, "a").withColumn("wiki", F.when(F.col("wiki") != "kowiki", F.col("wiki")))
    Mf.publish(rows, scratch, PARTS, ["page_id"])
    Mf.publish(rows.where("wiki is null").limit(2), scratch, PARTS, ["page_id"])
    got = Mf.read(spark, scratch, rows.schema)
    assert got.where("wiki is null").count() == 2 and got.count() == 12


def test_a_killed_write_changes_nothing(spark, scratch, monkeypatch):
    """The write dies after the first of two partitions; readers see the old snapshot whole."""
    first = _rows(spark, 30, "a")
    Mf.publish(first, scratch, PARTS, ["page_id"])

    @F.udf("string")
    def dies(wiki, title):
        if wiki == "kowiki":
            raise RuntimeError("killed")
        return title
    spread = Mf.spread
    # behind the shuffle, so that it fails in the writing tasks
    monkeypatch.setattr(Mf, "spread", lambda *a: spread(*a).sortWithinPartitions("wiki").withColumn("page_title", dies("wiki", "page_title")))
    with pytest.raises(Exception, match="killed"):
        Mf.publish(_rows(spark, 30, "b"), scratch, PARTS, ["page_id"])
    assert Mf.current_version(spark, scratch) == 1 and same_rows(Mf.read(spark, scratch, first.schema), first)


def test_a_writer_killed_before_its_manifest(spark, scratch, monkeypatch):
    first, second = _rows(spark, 30, "a"), _rows(spark, 30, "b")
    Mf.publish(first, scratch, PARTS, ["page_id"])

    def dies(*a):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(Mf, "_by_file", dies)
        with pytest.raises(KeyboardInterrupt):
            Mf.publish(second, scratch, PARTS, ["page_id"])
    assert len(glob.glob(scratch + "/data/write=*/wiki=*/snapshot=*/*.parquet")) == 6  # all files of the second are there
    assert same_rows(Mf.read(spark, scratch, first.schema), first)
    assert Mf.publish(second, scratch, PARTS, ["page_id"]) == 2 and same_rows(Mf.read(spark, scratch, first.schema), second)


def test_damage_is_found(spark, scratch):
    """A file that holds other rows than its manifest says, and one that has lost one."""
    rows = _rows(spark, 30, "a")
    Mf.publish(rows, scratch, PARTS, ["page_id"])
    assert Mf.damaged(spark, scratch, rows.schema, PARTS).count() == 0
    wiki = F.col("partition")["wiki"]
    said = Mf.manifest(spark, scratch).withColumns({"n_rows": F.when(wiki == "frwiki", 31).otherwise(F.col("n_rows")).cast("bigint"),
                                                   "checksum": F.when(wiki == "kowiki", 1).otherwise(F.col("checksum")).cast("bigint")})
    said.coalesce(1).write.parquet(scratch + "/manifest/version=2")
    bad = {(r.file.split("wiki=")[1].split("/")[0], r.n_rows, r.found_rows, r.checksum == r.found_checksum) for r in Mf.damaged(spark, scratch, rows.schema, PARTS).collect()}
    assert bad == {("frwiki", 31, 30, True), ("kowiki", 30, 30, False)}


def test_what_was_sent_is_what_is_published(spark, scratch, monkeypatch):
    rows = _rows(spark, 30, "a")
    monkeypatch.setattr(Mf, "spread", lambda df, *a: df.where("page_id <> '7'"))
    with pytest.raises(Mf.PublicationError, match="87 of 90"):
        Mf.publish(rows, scratch, PARTS, ["page_id"])
    assert Mf.current_version(spark, scratch) == 0


def test_rejects(spark, scratch):
    lines = StandIns(spark, SF_SMALL).candidate_lines
    lines.write.partitionBy("wiki_db").text(scratch + "/lines")
    rows = R.read_judged_tsv(spark, scratch + "/lines", MONTH, header=False)
    good, bad = R.accepted(rows), R.rejected(rows)
    assert good.count() + bad.count() == lines.count() == rows.count()
    reasons = {r.reason: r.n for r in bad.groupBy("reason").agg(F.count("*").alias("n")).collect()}
    assert set(reasons) == {R.BAD_LINE, R.BAD_ID, R.BAD_TEXT, R.NO_CANDIDATE, R.NO_IMAGE} and good.count() == lines.count() / 4
    # reading one column must not make a malformed line good
    assert rows.select("reason", "page_id").where(F.col("reason") == R.BAD_LINE).count() == reasons[R.BAD_LINE]
    whole = {r.line for r in bad.where(F.col("reason") == R.BAD_LINE).collect()}
    assert whole == {r.value for r in lines.where("size(split(value, '\t')) <> 6").collect()}


def test_rejects_of_a_raw_table(spark, raw_data):
    rows = R.judged(raw_data)
    assert {r.page_id: r.reason for r in rows.collect()} == {"7001": None, "7002": None, "7003": None, "7004": R.BAD_TEXT}
    assert R.accepted(rows).columns == raw_data.columns and R.rejected(rows).count() == 1


def test_quantile_sketches_merge(spark):
    """The merged quantile's exact rank lies within the bound; more snapshots do not read old rows."""
    df = spark.range(200_000).select((F.xxhash64("id") % 1_000_003).alias("v"), (F.col("id") % 7).alias("wiki"), F.when(F.col("id") < 150_000, "a").otherwise("b").alias("snapshot"))
    sketches = E.quantile_sketches(df, "v", ("wiki", "snapshot"))
    for q in (0.1, 0.5, 0.99):
        (got,) = E.checked_quantile(E.merged_quantile(sketches, q), df, "v", E.SKETCH_ERROR).collect()
        assert got.within_bound and got.n == 200_000 and got.rank_below <= got.rank_to
    by_wiki = E.merged_quantile(sketches, 0.5, ("wiki",)).collect()
    assert len(by_wiki) == 7
    assert E.merged_quantile(E.quantile_sketches(df.limit(0), "v", ("wiki",)), 0.5).count() == 0
    assert max(len(r.sketch) for r in sketches.collect()) < 40_000


def _plain_top(rows, k):
    count = {}
    for r in rows:
        count[r] = count.get(r, 0) + 1
    order = sorted(count.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))
    return [(v, n, i + 1) for i, (v, n) in enumerate(order[:k])]


@pytest.mark.parametrize("tracked", (E.TRACKED, 12))
def test_top_values(spark, monkeypatch, tracked):
    """Skewed, constant, null, near-unique and array columns; with a small sketch more columns are counted whole."""
    monkeypatch.setattr(E, "TRACKED", tracked)
    monkeypatch.setattr(E, "MISSED", 7 / 4096 if tracked > 12 else 7 / 16)
    df = spark.range(9000).select(
        F.col("id").cast("string").alias("unique"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 700)).alias("skewed"),
        F.lit("n").alias("constant"), F.when(F.col("id") % 5 > 0, F.col("id") % 4).alias("holes"), F.array(F.col("id") % 2).alias("list"), (F.col("id") % 2).alias("part"))
    got = {}
    for r in E.top_values(df, 5, ("part",)).orderBy("place").collect():
        got.setdefault(r["column"], []).append((r["value"], r["count"], r["place"]))
    rows = df.withColumn("list", F.to_json("list")).select(*[F.col(c).cast("string") for c in df.columns]).collect()
    assert got == {c: _plain_top([r[c] for r in rows], 5) for c in df.columns}
    assert E.top_values(df.limit(0), 5).count() == 0


def test_metric_state_reads_a_new_snapshot_once(spark, scratch):
    """The second update and all reports leave the first snapshot's production files unread."""
    from picsel.operators import metric_state as Ms
    from picsel.operators import publish as D
    from picsel.plans.registry import run_for
    from scans import scans
    prod = run_for(spark, SF_SMALL).production_table("ds", 1.0)
    older = prod.where(F.col("image_id").isNotNull()).withColumn("snapshot", F.lit("2020-12"))
    both = prod.unionByName(older)
    D.publish_production(both, scratch + "/prod")
    back = spark.read.schema(both.schema).parquet(scratch + "/prod")
    Ms.update(back, scratch + "/state", "2020-12")
    first = Ms.snapshot_counts(spark, scratch + "/state").collect()
    counts = Ms.counts(back, MONTH)
    counts.collect()
    wikis = prod.select("wiki").distinct().count()
    assert scans(counts, "/prod") and all(s["numPartitions"] == wikis for s in scans(counts, "/prod"))  # of twice as many folders
    Ms.update(back, scratch + "/state", MONTH)
    Ms.update(back, scratch + "/state", MONTH)  # replaces itself
    state = scratch + "/state"
    assert {tuple(r) for r in first} <= {tuple(r) for r in Ms.snapshot_counts(spark, state).collect()}
    assert same_rows(Ms.snapshot_counts(spark, state), E.snapshot_counts(both).select("snapshot", "wiki", "n"))
    for s, one in ((MONTH, prod), ("2020-12", older)):
        assert same_rows(Ms.suggestion_histogram(spark, state).where(F.col("snapshot") == s).drop("snapshot"), E.suggestion_histogram(one))
        assert same_rows(Ms.suggestions_by_confidence(spark, state).where(F.col("snapshot") == s).drop("snapshot"), E.suggestions_by_confidence(one))
        want = E.found_on_histogram(E.found_on_sizes(one)).select(F.col("num_languages").cast("bigint"), "n")
        assert same_rows(Ms.found_on_histogram(spark, state).where(F.col("snapshot") == s).drop("snapshot"), want)
    total = {r.n_images: r.n_pages for r in Ms.suggestion_histogram(spark, state).where("snapshot is null").collect()}
    assert sum(total.values()) == sum(r.n_pages for r in Ms.suggestion_histogram(spark, state).where("snapshot is not null").collect())
    sizes = E.found_on_sizes(prod).unionByName(E.found_on_sizes(older))
    (got,) = E.checked_quantile(Ms.found_on_median(spark, state), sizes, "num_languages", E.SKETCH_ERROR).collect()
    assert got.within_bound and Ms.found_on_median(spark, state, ("wiki",)).count() <= wikis


@pytest.mark.parametrize("by", ((), ("part",)))
def test_frequency_sketches_of_tasks_without_rows(spark, by):
    df = spark.range(30).select((F.col("id") % 4).alias("v"), (F.col("id") % 2).alias("part")).repartition(60)
    likely = E.likely_values(E.value_sketches(df, by).repartition(40), df.columns)
    assert {tuple(r) for r in likely.collect()} == {("v", str(v)) for v in range(4)} | {("part", "0"), ("part", "1")}
    assert E.likely_values(E.value_sketches(df.limit(0), by), df.columns).count() == 0
