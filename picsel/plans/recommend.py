"""The recommendation run as staged Spark plans: sources -> pool -> selection -> raw -> production.

Intermediate results that several later steps read (unillustrated pages, item claims, the pool's long
forms) are materialised with a reliable ``checkpoint()`` into the session's ``spark.checkpoint.dir``
(a shared folder on a cluster). That cuts the lineage, so a lost executor only recomputes the current
stage, and it keeps each later plan small instead of re-inlining the shared subtrees into every consumer.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from picsel import constants as K
from picsel.operators import pool as P
from picsel.operators import publish as D
from picsel.operators import selection as S
from picsel.functions.columns import month_of_str
from picsel.session import materialize
from picsel.sources.readers import snapshot_scan
from picsel.sources.standins import FULL_DATE, MONTH, StandIns


def materialize_all(frames: dict[str, DataFrame], enabled: bool = True) -> dict[str, DataFrame]:
    """Materialise independent frames as concurrent Spark jobs (one driver thread per frame).

    The jobs share the cluster; small stages of one job overlap with those of the others.
    """
    if not enabled:
        return dict(frames)
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=min(4, len(frames))) as pool:
        futures = {name: pool.submit(materialize, df, True, name) for name, df in frames.items()}
        return {name: f.result() for name, f in futures.items()}


@dataclass
class SourceTables:
    """The snapshot tables one run reads (already restricted to the run's snapshots)."""
    page: DataFrame
    imagelinks: DataFrame
    page_props: DataFrame
    item_page_link: DataFrame
    categorylinks: DataFrame
    placeholder_category: DataFrame
    entity: DataFrame | None = None
    claims_flat: DataFrame | None = None
    labels_flat: DataFrame | None = None

    @classmethod
    def from_standins(cls, src: StandIns, month: str = MONTH, full: str = FULL_DATE) -> "SourceTables":
        return cls(
            page=snapshot_scan(src.page, month),
            imagelinks=snapshot_scan(src.imagelinks, month),
            page_props=snapshot_scan(src.page_props, month),
            item_page_link=snapshot_scan(src.item_page_link, full),
            categorylinks=snapshot_scan(src.categorylinks, month),
            placeholder_category=src.placeholder_category,
            entity=snapshot_scan(src.entity, full),
            claims_flat=src.claims,
            labels_flat=src.labels,
        )


    @classmethod
    def _read(cls, read, date: str) -> "SourceTables":
        """Tables by ``read(name)``; MediaWiki tables carry the month of ``date`` as snapshot, Wikidata tables the date."""
        month = month_of_str(date)
        monthly = {n: snapshot_scan(read(n), month) for n in ("page", "imagelinks", "page_props", "categorylinks")}
        dated = {n: snapshot_scan(read(n), date) for n in ("item_page_link", "entity")}
        return cls(**monthly, **dated, placeholder_category=read("placeholder_category"))

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, date: str) -> "SourceTables":
        """Folders ``root/<table>``, partitioned by snapshot (and wiki_db)."""
        # partition values stay text: a month is no date
        read = lambda n: spark.read.option("inferSchema", "false").parquet(f"{root}/{n}")
        return cls._read(lambda n: read(n).withColumn("snapshot", F.col("snapshot").cast("string")) if n != "placeholder_category" else read(n), date)

    @classmethod
    def from_catalog(cls, spark: SparkSession, date: str, names: dict[str, str] | None = None) -> "SourceTables":
        """Tables of the session's catalog; ``names`` maps the fields of this class to table names."""
        return cls._read(lambda n: spark.table((names or {}).get(n, n)), date)


@dataclass
class RecommendationRun:
    """One run over all wikis. ``checkpoints=False`` keeps everything lazy (one big plan)."""
    tables: SourceTables
    snapshot: str = MONTH
    seed: str = K.DEFAULT_DRAW_SEED
    checkpoints: bool = True
    use_entity: bool = True
    wikis: tuple[str, ...] | None = None  # restrict the articles to these wikis (the per-wiki loop)

    @classmethod
    def standin(cls, spark: SparkSession, sf_dir: str, date: str = FULL_DATE, **kw) -> "RecommendationRun":
        """A run over the stand-in tables; ``date`` selects the snapshots that are read and names those that are written."""
        month = month_of_str(date)
        return cls(SourceTables.from_standins(StandIns(spark, sf_dir), month, date), snapshot=month, **kw)

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, date: str, **kw) -> "RecommendationRun":
        return cls(SourceTables.from_parquet(spark, root, date), snapshot=month_of_str(date), **kw)

    @classmethod
    def from_catalog(cls, spark: SparkSession, date: str, names: dict[str, str] | None = None, **kw) -> "RecommendationRun":
        return cls(SourceTables.from_catalog(spark, date, names), snapshot=month_of_str(date), **kw)

    # -- pool ----------------------------------------------------------------------------------------
    @cached_property
    def placeholders(self) -> DataFrame:
        t = self.tables
        return materialize(P.placeholder_images(t.categorylinks, t.page, t.placeholder_category),
                           self.checkpoints, "placeholders")

    def _local(self, df: DataFrame) -> DataFrame:
        return df if self.wikis is None else df.where(F.col("wiki_db").isin(*self.wikis))

    @cached_property
    def icons(self) -> DataFrame:
        """B3, written once: it is counted, and the links are cut by it."""
        t = self.tables
        sizes = P.wiki_size(self._local(t.page))
        return materialize(P.icon_images(self._local(t.imagelinks), P.icon_thresholds(sizes)), self.checkpoints, "icons")

    @cached_property
    def illustrated(self) -> DataFrame:
        t = self.tables
        # repeats: the union makes the set, in one aggregation
        return P.illustrated_pages(P.pages_with_images(self._local(t.imagelinks), self.icons, repeats=True),
                                   P.pages_with_lead_image(self._local(t.page_props), repeats=True))

    @cached_property
    def unillustrated(self) -> DataFrame:
        t = self.tables
        return materialize(P.unillustrated_pages(self._local(t.page), t.item_page_link, self.illustrated),
                           self.checkpoints, "unillustrated")

    def _prefetch(self, *names: str) -> None:
        """Evaluate independent stage properties as concurrent jobs (different attributes per thread)."""
        todo = [n for n in names if n not in self.__dict__]
        if len(todo) < 2 or not self.checkpoints:
            return
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=len(todo)) as pool:
            for f in [pool.submit(getattr, self, n) for n in todo]:
                f.result()

    @cached_property
    def claims(self) -> DataFrame:
        self._prefetch("placeholders", "unillustrated")
        t = self.tables
        if self.use_entity and t.entity is not None:
            out = P.item_claims(t.entity, self.unillustrated)
        else:
            out = P.item_claims_flat(t.claims_flat, t.labels_flat, self.unillustrated)
        return materialize(out, self.checkpoints, "claims")

    @cached_property
    def lead_images(self) -> DataFrame:
        """B12; it needs no claims."""
        self._prefetch("placeholders", "unillustrated")
        t = self.tables
        leads = P.lead_images_elsewhere(
            self.unillustrated.select("wiki_db", "item_id", "page_id"),
            P.item_lead_images(t.item_page_link, t.page_props, t.page, self.placeholders, self.unillustrated))
        return materialize(leads, self.checkpoints, "lead_images")

    @cached_property
    def pool(self) -> P.Pool:
        t = self.tables
        self._prefetch("placeholders", "unillustrated")
        self._prefetch("claims", "lead_images")
        pages = self.unillustrated.join(self.claims.withColumnRenamed("id", "item_id"),
                                        ["wiki_db", "item_id"], "left")
        cat_files = P.category_images(self.claims, t.categorylinks, t.page, self.placeholders)
        done = materialize_all({"pool_pages": pages, "category_files": cat_files}, self.checkpoints)
        return P.Pool(pages=done["pool_pages"], lead_images=self.lead_images,
                      category_files=done["category_files"])

    @cached_property
    def numbered_category_images(self) -> DataFrame:
        return materialize(P.numbered_category_images(self.pool.category_files), self.checkpoints,
                           "numbered_category_images")

    @cached_property
    def eligible_leads(self) -> DataFrame:
        """Lead images of the pages that may receive candidates."""
        keys = S.eligible_pages(self.pool.pages).select(*P.PAGE_KEYS)
        return self.pool.lead_images.join(keys, P.PAGE_KEYS, "left_semi")

    @cached_property
    def lead_wikis(self) -> list[str]:
        """The wikis that have lead images, sorted (one entry a wiki)."""
        return sorted(r.src_wiki for r in self.pool.lead_images.select("src_wiki").distinct().collect())

    @cached_property
    def ranked_leads(self) -> DataFrame:
        """C2 and C3."""
        return S.rank_lead_images_by_bitmap(self.eligible_leads, self.lead_wikis, listed=self.pool.lead_images)

    def pool_rows(self) -> DataFrame:
        """B13."""
        return P.candidate_pool(self.pool)

    # -- selection -----------------------------------------------------------------------------------
    def merged(self) -> DataFrame:
        """C7."""
        pool = self.pool
        self._prefetch("numbered_category_images", "ranked_leads")
        eligible = S.eligible_pages(pool.pages)
        return S.merge_sources(
            S.draw_category_images(eligible, pool.category_files, self.seed, self.numbered_category_images),
            self.ranked_leads,
            S.item_image_candidates(eligible),
        )

    def top_candidates(self) -> DataFrame:
        """C8 long form."""
        return S.top_candidates(self.merged())

    @cached_property
    def candidates(self) -> DataFrame:
        """C9."""
        return S.candidates_table(self.pool, self.top_candidates())

    @cached_property
    def raw(self) -> DataFrame:
        """The raw (imagerec) rows of this run, staged once: the publication and all metrics read them."""
        return materialize(S.raw_rows(self.candidates, self.snapshot), self.checkpoints, "raw")

    # -- publication ---------------------------------------------------------------------------------
    def production_rows(self) -> DataFrame:
        """D9."""
        return D.production_rows(self.raw)

    def production_table(self, dataset_id: str, insertion_ts: float) -> DataFrame:
        """D10 transform half, lazy over the staged raw rows."""
        return D.production_table(self.production_rows(), self.snapshot, dataset_id, insertion_ts)
