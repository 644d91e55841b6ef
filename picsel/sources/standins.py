"""Stand-in source tables derived from the supplied synthetic tables.

They give orders / lineitem / part / documents the shape of the MediaWiki and Wikidata snapshot tables the
pipeline reads, so that every operator has data whose size grows with the inputs. The DuckDB oracle defines
the very same views in SQL (``picsel.plans.oracle``). Each attribute is a lazy DataFrame over the parquet scans, so
Catalyst prunes columns and pushes filters into the scans; only ``file_pages`` runs a job, a count of its keys.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from picsel.functions.columns import image_page_url

MONTH = "2021-01"
FULL_DATE = "2021-01-25"
STANDIN_WIKIS = ("enwiki", "arwiki", "frwiki", "kowiki")
FILE_PAGE_LANGUAGES = (("en", "ltr"), ("ar", "rtl"), ("fr", "ltr"), ("ko", "ltr"))
#: Keys whose file pages (one in each language) are built in one task.
FILE_KEYS_PER_TASK = 2_500
PLACEHOLDER_CATEGORIES = ("Category_7", "Category_13")


def _wiki(k: Column) -> Column:
    expr = None
    for i, w in enumerate(STANDIN_WIKIS):
        cond = (k % 4) == i
        expr = F.when(cond, F.lit(w)) if expr is None else expr.when(cond, F.lit(w))
    return expr


def _item_num(k: Column) -> Column:
    return F.floor(k / F.lit(4)).cast("bigint")


def _item(k: Column) -> Column:
    return F.concat(F.lit("Q"), _item_num(k).cast("string"))


def _json_str(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def _s(c: Column) -> Column:
    return c.cast("string")


def _item_id() -> Column:
    return F.concat(F.lit("Q"), _s(F.col("k")))


def _item_claims() -> list[tuple[str, Column, Column]]:
    """Of an item key ``k``, for each property: its name, whether the item has it, and its value."""
    k = F.col("k")
    p18 = _json_str(
        F.when(k % 35 == 0, F.concat(F.lit("Flag of "), _s(k), F.lit(".jpg")))
        .when(k % 10 == 0, F.concat(F.lit("File_"), _s(k % 200), F.lit(".jpg")))
        .otherwise(F.concat(F.lit("Photo "), _s(k), F.lit(".jpg"))))
    p373 = _json_str(F.concat(F.lit("Category "), _s(k % 50)))
    n = (F.when(k % 11 == 0, 577).when(k % 13 == 0, 4167410).when(k % 17 == 0, 101352)
         .otherwise(5)).cast("bigint")
    p31 = F.concat(F.lit('{"entity-type":"item","numeric-id":'), _s(n), F.lit(',"id":"Q'), _s(n), F.lit('"}'))
    return [("P18", k % 5 == 0, p18), ("P373", k % 3 == 0, p373), ("P31", F.lit(True), p31)]


def _item_languages() -> Column:
    return F.array(F.lit("en"), F.lit("ar"), F.lit("fr"), F.when(F.col("k") % 7 != 0, F.lit("ko")))


def _item_label(lang: Column) -> Column:
    return F.concat(F.lit("Label "), _s(F.col("k")), F.lit(" "), lang)


@dataclass
class StandIns:
    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- MediaWiki tables (monthly snapshot) ---------------------------------------------------------
    @cached_property
    def page(self) -> DataFrame:
        o = self.table("orders")
        k = F.col("o_orderkey")
        articles = o.select(
            _wiki(k).alias("wiki_db"), F.lit(MONTH).alias("snapshot"), k.alias("page_id"),
            F.concat(F.lit("Page_"), _s(k)).alias("page_title"),
            F.when(F.col("o_orderpriority") == "5-LOW", 1).otherwise(0).alias("page_namespace"),
            F.when((F.col("o_orderstatus") == "P") & (k % 3 == 0), 1).otherwise(0).alias("page_is_redirect"),
            F.col("o_totalprice").cast("double").alias("page_len"),
        )
        p = self.table("part")
        pk = F.col("p_partkey")
        files = p.select(
            F.lit("commonswiki").alias("wiki_db"), F.lit(MONTH).alias("snapshot"), pk.alias("page_id"),
            F.concat(F.lit("File_"), _s(pk), F.lit(".jpg")).alias("page_title"),
            F.lit(6).alias("page_namespace"),
            F.when(F.col("p_type") == "PROMO", 1).otherwise(0).alias("page_is_redirect"),
            F.col("p_size").cast("double").alias("page_len"),
        )
        return articles.unionByName(files)

    @cached_property
    def imagelinks(self) -> DataFrame:
        k = F.col("l_orderkey")
        return self.table("lineitem").select(
            _wiki(k).alias("wiki_db"), F.lit(MONTH).alias("snapshot"), k.alias("il_from"),
            F.concat(F.lit("File_"), _s(F.col("l_partkey")), F.lit(".jpg")).alias("il_to"),
            F.lit(0).alias("il_from_namespace"),
        )

    @cached_property
    def page_props(self) -> DataFrame:
        k = F.col("l_orderkey")
        flag = F.col("l_returnflag")
        value_num = ((_item_num(k) + F.col("l_partkey") % 2) % 200).cast("bigint")
        # an order's first line gives its page's lead image, the others are other properties
        first = F.col("l_linenumber") == 1
        return self.table("lineitem").select(
            _wiki(k).alias("wiki_db"), F.lit(MONTH).alias("snapshot"), k.alias("pp_page"),
            F.when(first & (flag == "A"), "page_image").when(first & (flag == "N"), "page_image_free")
            .otherwise("defaultsort").alias("pp_propname"),
            F.concat(F.lit("File_"), _s(value_num), F.lit(".jpg")).alias("pp_value"),
        )

    @cached_property
    def categorylinks(self) -> DataFrame:
        pk = F.col("p_partkey")
        return self.table("part").select(
            F.lit("commonswiki").alias("wiki_db"), F.lit(MONTH).alias("snapshot"), pk.alias("cl_from"),
            F.concat(F.lit("Category_"), _s(pk % 50)).alias("cl_to"),
            F.when(F.col("p_size") < 5, "subcat").otherwise("file").alias("cl_type"),
        )

    @cached_property
    def placeholder_category(self) -> DataFrame:
        rows = [(str(i + 1), t) for i, t in enumerate(PLACEHOLDER_CATEGORIES)]
        return self.spark.createDataFrame(rows, "id string, title string")

    # -- Wikidata tables (full-date snapshot) --------------------------------------------------------
    @cached_property
    def item_page_link(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.table("orders").select(
            F.lit(FULL_DATE).alias("snapshot"), _item(k).alias("item_id"), k.alias("page_id"),
            F.lit(0).alias("page_namespace"), _wiki(k).alias("wiki_db"),
        )

    @cached_property
    def _item_keys(self) -> DataFrame:
        return self.table("orders").select(_item_num(F.col("o_orderkey")).alias("k")).distinct()

    @cached_property
    def claims(self) -> DataFrame:
        """Flattened claims: (item_id, property, value), value JSON-encoded as in the real table."""
        return reduce(DataFrame.unionByName, [
            self._item_keys.where(has).select(_item_id().alias("item_id"), F.lit(prop).alias("property"), value.alias("value"))
            for prop, has, value in _item_claims()])

    @cached_property
    def labels(self) -> DataFrame:
        """Flattened labels: (item_id, lang, label); ``ko`` only where k % 7 <> 0."""
        k = F.col("k")
        return (
            self._item_keys.select(k, F.explode(_item_languages()).alias("lang"))
            .where(F.col("lang").isNotNull())
            .select(_item_id().alias("item_id"), "lang", _item_label(F.col("lang")).alias("label"))
        )

    @cached_property
    def entity(self) -> DataFrame:
        """Nested entity table: labels map<string,string>, claims array<struct<mainSnak:...>>.

        The items of :attr:`claims` and :attr:`labels`, each built where its key lies: flattened rows would have to be gathered again.
        """
        snak = lambda prop, value: F.struct(F.struct(F.lit(prop).alias("property"), F.struct(value.alias("value")).alias("datavalue")).alias("mainSnak"))
        claims = F.concat(*[F.when(has, F.array(snak(prop, value))).otherwise(F.array()) for prop, has, value in _item_claims()])
        entries = F.transform(F.array_compact(_item_languages()), lambda lang: F.struct(lang.alias("lang"), _item_label(lang).alias("label")))
        return self._item_keys.select(
            F.lit(FULL_DATE).alias("snapshot"), _item_id().alias("id"), F.lit("item").alias("typ"), F.map_from_entries(entries).alias("labels"),
            F.when(_item_id().isNotNull(), claims).alias("claims"))

    # -- Image pages with the markup of the metadata extractor (F4-F6) -------------------------------
    @cached_property
    def file_pages(self) -> DataFrame:
        """``url, html`` of each part's file page in four languages; the fields present depend on the part key.

        A few MB of keys become pages of a hundred times their size, so the counted keys are dealt out before that: as splits of
        the file they would lie in one task.
        """
        langs = F.array(*[F.struct(F.lit(a).alias("lang"), F.lit(d).alias("dir")) for a, d in FILE_PAGE_LANGUAGES])
        keys = self.table("part").select(F.col("p_partkey").alias("k"))
        p = keys.repartition(max(1, -(-keys.count() // FILE_KEYS_PER_TASK))).select("k", F.explode(langs).alias("l")).select("k", "l.lang", "l.dir")
        k = _s(F.col("k"))
        div = lambda cls, body, more="": F.concat(F.lit('<div class="'), cls, F.lit(f'"{more}>'), body, F.lit("</div>"))
        own = F.concat(F.lit("description"), F.when(F.col("k") % 8 == 1, "  ").otherwise(" "), F.lit("mw-content-"), "dir", F.lit(" "), "lang")
        m = F.col("k") % 4
        description = (
            F.when(m == 1, div(own, F.concat(F.lit(" About "), k, F.lit(" in "), "lang", F.lit(" "))))
            .when(m == 2, F.concat(div(own, F.concat(F.lit("First "), k)), div(own, F.concat(F.lit("Last <b>"), k, F.lit("</b> &amp; "), "lang"))))
            .when(m == 3, div(F.lit("description"), F.concat(F.lit("Plain "), k))).otherwise(F.lit("")))
        captioned = lambda cls: F.concat(F.lit(f'<div class="{cls}" lang="'), "lang", F.lit('">Caption '), k, F.lit("</div>"))
        caption = (F.when(F.col("k") % 3 == 0, captioned("wbmi-caption-value")).when(F.col("k") % 3 == 1, captioned("wbmi-caption-value more"))
                   .otherwise(F.lit("")))
        value = lambda name, prop, text: F.concat(F.lit(f'"{name}": {{"text/plain": {{"'), "lang", F.lit(f'": {{"{prop}": "'), text, F.lit('"}}}'))
        # the first entry is skipped whatever its shape; an entry that is no object gives no value
        first = F.when(F.col("k") % 20 == 0, '"text"').when(F.col("k") % 20 == 5, "[1, 2]").when(F.col("k") % 20 == 10, "null").otherwise("{}")
        block = lambda prop, *values: F.concat(F.lit(f"<div data-property=\"{prop}\" data-formatvalue='"), F.lit('{"first": '), first, F.lit(', "odd": 7, '),
                                               F.concat_ws(", ", *values), F.lit("}'></div>"))
        thing = lambda n: F.concat(F.lit("thing "), _s(F.col("k") % n))
        depicts = (F.when(F.col("k") % 5 == 0, F.concat(block("P180", value("a", "P180", thing(7)), value("b", "P180", thing(3))),
                                                        block("P275", value("c", "P275", F.lit("CC0")))))
                   .when(F.col("k") % 5 == 1, F.lit("<div data-property='P180' data-formatvalue='broken'></div>")).otherwise(F.lit("")))
        image = F.concat(F.lit("File_"), k, F.lit(".jpg"))
        return p.select(image_page_url(image, F.col("lang")).alias("url"),
                        F.concat(F.lit("<html><body>"), description, caption, depicts, F.lit("</body></html>")).alias("html"),
                        F.col("k").alias("file_key"), "lang", "dir")

    # -- Lines of candidate files, good and bad (A4) -------------------------------------------------
    @cached_property
    def candidate_lines(self) -> DataFrame:
        """``value, wiki_db``: a TSV line for each document. Of eight, one each has too few fields, too many, no numeric page id, an empty
        list, no JSON, and a candidate without image; two are good, one of them without candidates."""
        d, m = F.col("doc_id"), F.col("doc_id") % 8
        quoted = lambda json_text: F.lit('"' + json_text.replace('"', '""') + '"')
        cell = (F.when(m == 1, "").when(m == 5, "[]").when(m == 6, "not json")
                .when(m == 7, quoted('[{"image": null, "rating": 1, "note": "image was in the Wikidata item"}]'))
                .otherwise(quoted('[{"image": "A, \\"B\\".jpg", "rating": 1, "note": "image was in the Wikidata item"}]')))
        page = F.concat(F.when(m == 4, "x").otherwise(""), _s(d))
        line = F.concat_ws("\t", _s(d), F.concat(F.lit("Q"), _s(d)), page, F.concat(F.lit("Doc "), _s(d)), cell, F.lit(""))
        line = F.when(m == 2, F.concat_ws("\t", _s(d), F.concat(F.lit("Q"), _s(d)))).when(m == 3, F.concat(line, F.lit("\tmore"))).otherwise(line)
        return self.table("documents").select(line.alias("value"), F.concat(F.col("lang"), F.lit("wiki")).alias("wiki_db"))

    # -- Raw candidates table stand-in from documents (for isolated publication tests) ---------------
    @cached_property
    def raw_from_documents(self) -> DataFrame:
        d = F.col("doc_id")
        # lists of wikis with a line break (as JSON text) within, behind and before them
        listed = (F.when(d % 4 == 1, r"Wikis: ruwiki,\n itwiki").when(d % 4 == 2, r"Wikis: ruwiki, itwiki\n")
                  .when(d % 4 == 3, r"Wikis:\n ruwiki, itwiki").otherwise("Wikis: ruwiki, itwiki"))
        entries = []
        for i, (rating, note) in enumerate(
            [("1", F.lit("image was in the Wikidata item")),
             ("2.1", F.concat(F.lit("image was found in the following "), listed)),
             ("3", F.lit("image was found in the Commons category linked in the Wikidata item"))], start=1):
            entries.append(F.concat(
                F.lit('{"image": "File_'), _s(d * 3 + i), F.lit('.jpg", "rating": ' + rating + ', "note": "'),
                note, F.lit('"}')))
        m = d % 5
        tc = (F.when(m == 0, F.lit(None).cast("string"))
              .when(m == 1, F.concat(F.lit("["), entries[0], F.lit("]")))
              .when(m == 2, F.concat(F.lit("["), entries[0], F.lit(", "), entries[1], F.lit("]")))
              .when(m == 3, F.concat(F.lit("["), entries[0], F.lit(", "), entries[1], F.lit(", "),
                                     entries[2], F.lit("]")))
              .otherwise(F.lit("top_candidates")))
        inst = (F.when(d % 7 == 0, F.lit('{"entity-type":"item","numeric-id":577,"id":"Q577"}'))
                .when(d % 7 == 1, F.lit('{"entity-type":"item","numeric-id":101352,"id":"Q101352"}'))
                .when(d % 7 == 2, F.lit("not json")))
        return self.table("documents").select(
            _s(d).alias("pandas_idx"), F.concat(F.lit("Q"), _s(d)).alias("item_id"), _s(d).alias("page_id"),
            F.concat(F.lit("Doc_"), _s(d)).alias("page_title"), tc.alias("top_candidates"),
            inst.alias("instance_of"), F.concat(F.col("lang"), F.lit("wiki")).alias("wiki_db"),
            F.lit(MONTH).alias("snapshot"),
        )
