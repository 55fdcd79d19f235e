"""Registered source/sink round trips: Spark writes a store derived from the
driver tables into the shared checkpoint folder, then scans it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.functions import urls as ux
from tessera.operators import links, series, terms
from tessera.operators import raster as rx
from tessera.plans.raster import MASK_LEVEL, SIDE
from tessera.plans.registry import register, sql_str
from tessera.plans.sqltext import sql_preprocess, sql_term_counts
from tessera.plans.sqlweb import sql_page_text, sql_url_part
from tessera.plans.text import CATEGORIES, EVENT_TYPES, _TOTALS_SQL, doc_term_counts
from tessera.session import default_parallelism, scratch_path, stored
from tessera.sources import csvio
from tessera.sources import images as im
from tessera.sources import pages as ps
from tessera.sources.tables import read_table

CRAWL_DATE = "2024-01-01"


def _store(spark, sf):
    """Cycle 1 of the page store: saved (non-blank) pages by domain."""
    p = read_table(spark, sf, "pages", ["page_id", "url", "html"])
    t = links.page_texts(p, ["page_id", "url"]).filter(tx.nonblank("page_text"))
    rows = t.select(F.lit(1).alias("cycle"), ux.domain("url").alias("domain"), "url",
                    F.lit(CRAWL_DATE).alias("date"), F.col("page_text").alias("text"))
    path = scratch_path(spark, "page-store")
    ps.write_page_store(rows, path)
    return path


_PAGES_SQL = (f"SELECT 1 AS cycle, replace({sql_url_part('url', 'authority')}, 'www.', '') AS domain, "
              f"url, '{CRAWL_DATE}' AS date, t FROM (SELECT url, {sql_page_text('html')} AS t FROM pages) "
              "WHERE trim(t) <> ''")


@register("page_store_roundtrip",
          f"SELECT cycle, domain, url, date, {sql_preprocess('t')} AS content, 2 AS next_cycle "
          f"FROM ({_PAGES_SQL})")
def page_store_roundtrip(spark, sf):
    path = _store(spark, sf)
    return ps.scan_page_store(spark, path).select(
        "cycle", "domain", "url", "date", tx.preprocess_text("content").alias("content"),
        F.lit(ps.next_cycle(spark, path)).alias("next_cycle"))


@register("page_store_replay",
          f"SELECT cycle, domain, count(*) AS pages, TRUE AS intact FROM (SELECT * FROM ({_PAGES_SQL}) "
          f"UNION ALL SELECT 2, domain, url, date, t FROM ({_PAGES_SQL}) WHERE starts_with(url, 'https:')) GROUP BY ALL")
def page_store_replay(spark, sf):
    """Two cycles of the store: the first replayed over a wider attempt that went
    before it, the second committed once; a third was never committed."""
    p = read_table(spark, sf, "pages", ["page_id", "url", "html"])
    t = links.page_texts(p, ["page_id", "url"]).filter(tx.nonblank("page_text"))
    rows = stored(t.select(ux.domain("url").alias("domain"), "url", F.lit(CRAWL_DATE).alias("date"), F.col("page_text").alias("text")), "pages-read")
    path = scratch_path(spark, "page-store-cycles")
    ps.commit_cycle(rows.unionByName(rows.withColumn("domain", F.concat(F.lit("x."), "domain"))), path, 1)
    ps.commit_cycle(rows, path, 1)
    ps.commit_cycle(rows.where(F.col("url").startswith("https:")), path, 2)
    ps.write_page_store(rows.select(F.lit(3).alias("cycle"), "*"), path)
    pages = ps.scan_committed(spark, path).groupBy("cycle", "domain").agg(F.count(F.lit(1)).alias("pages"))
    broken = [ps.damaged_domains(spark, path, c).select(F.lit(c).alias("cycle"), "domain", F.lit(True).alias("bad")) for c in (1, 2)]
    return pages.join(broken[0].unionByName(broken[1]), ["cycle", "domain"], "left").select(
        "cycle", "domain", "pages", F.col("bad").isNull().alias("intact"))


def _daily_sql() -> str:
    tc = sql_term_counts(f"(SELECT url AS k, t FROM ({_PAGES_SQL}))", "k", "t")
    cols = ", ".join(
        f"coalesce(sum(t.cnt) FILTER (WHERE t.category = {sql_str(c)}), 0)::BIGINT AS \"{c}\""
        for c in CATEGORIES)
    return (f"WITH tc AS ({tc}) SELECT p.date, {cols} FROM ({_PAGES_SQL}) p "
            "LEFT JOIN tc t ON t.k = p.url GROUP BY p.date")


@register("page_store_daily_series", _daily_sql())
def page_store_daily_series(spark, sf):
    """A2 as the analysis runs it: page store -> term counts -> date x category."""
    store = ps.scan_page_store(spark, _store(spark, sf)).withColumn("content", tx.preprocess_text("content"))
    hits = terms.term_matches(store, "content", ["date"], preprocessed=True, keep_empty=True)
    return series.zero_filled_pivot(hits.select("date", "category"), "date", "category", CATEGORIES)


@register("event_log_csv",
          "SELECT epoch_us(ts) AS ts_us, CAST(round(value) AS BIGINT) AS direct_terms, "
          "CAST(sum(CAST(round(value) AS BIGINT)) OVER (ORDER BY ts, CAST(round(value) AS BIGINT) "
          "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_terms FROM events")
def event_log_csv(spark, sf):
    ev = read_table(spark, sf, "events", ["ts", "value"]).select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.round("value").cast("long").alias("direct_terms"))
    path = scratch_path(spark, "event-log")
    csvio.append_event_log(ev, path)
    log = csvio.read_event_log(spark, path)
    cum = series.running_sum(log, ["timestamp", "direct_terms"], "direct_terms", "cumulative_terms")
    return cum.select(F.unix_micros("timestamp").alias("ts_us"), "direct_terms", "cumulative_terms")


@register("totals_csv_roundtrip",
          f"SELECT type AS \"Type\", name AS \"Name\", count AS \"Count\" FROM ({_TOTALS_SQL})")
def totals_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "totals-csv")
    csvio.write_totals_csv(terms.totals_long(doc_term_counts(spark, sf)), path)
    return csvio.read_totals_csv(spark, path)


@register("series_csv_roundtrip",
          "SELECT \"Date\", c AS category, n FROM (SELECT CAST(ts AS DATE) AS \"Date\", "
          + ", ".join(f"count(*) FILTER (WHERE event_type = {sql_str(t)}) AS {t}" for t in EVENT_TYPES)
          + " FROM events GROUP BY 1) UNPIVOT (n FOR c IN (" + ", ".join(EVENT_TYPES) + "))")
def series_csv_roundtrip(spark, sf):
    """The wide daily series through its CSV file, read back one row per cell."""
    ev = read_table(spark, sf, "events", ["ts", "event_type"]).select(F.to_date("ts").alias("date"), "event_type")
    path = scratch_path(spark, "series-csv")
    csvio.write_timeseries_csv(series.zero_filled_pivot(ev, "date", "event_type", EVENT_TYPES), path)
    return csvio.read_timeseries_csv(spark, path, EVENT_TYPES).unpivot("Date", EVENT_TYPES, "category", "n")


#: An image file is cut off where its first grey value is below the one level, a
#: mask file where its last is above the other; images of label NO_MASK have none.
DARK_FIRST, BRIGHT_LAST, NO_MASK = 110, 145, 3
_GREY = "list_transform(embedding, lambda e: CAST(floor((CAST(e AS DOUBLE) + 1) * 127.5) AS BIGINT))"


@register("image_folder_pairs",
          "SELECT concat('scan/', vec_id, '.png') AS filename, len(g) AS pixels, list_sum(g) AS grey_sum, list_sum(m) AS mask_sum "
          f"FROM (SELECT vec_id, label, g, list_transform(g, lambda v: CASE WHEN v >= {MASK_LEVEL} THEN v ELSE 0 END) AS m "
          f"FROM (SELECT vec_id, label, {_GREY} AS g FROM embeddings)) "
          f"WHERE g[1] >= {DARK_FIRST} AND g[{SIDE * SIDE}] <= {BRIGHT_LAST} AND label IS DISTINCT FROM {NO_MASK} AND list_sum(m) > 100")
def image_folder_pairs(spark, sf):
    """Image and mask folders, some files cut off and some masks missing, read
    through the image source: images with a readable mask that shows ink."""
    grey = F.transform("embedding", lambda e: F.floor((e.cast("double") + 1) * 127.5).cast("int"))
    rows = read_table(spark, sf, "embeddings", ["vec_id", "embedding", "label"])
    ims = rows.repartition(default_parallelism(spark), "vec_id").select(            # a file per row: writing is the work
        F.concat(F.lit("scan/"), F.col("vec_id"), F.lit(".png")).alias("filename"), "label", grey.alias("g"))

    def file_of(values, broken):
        png = im.png_bytes(values, F.lit(SIDE), F.lit(SIDE))
        return F.when(broken, F.substring(png, 1, 20)).otherwise(png).alias("content")

    img, lbl = scratch_path(spark, "image-folder"), scratch_path(spark, "mask-folder")
    im.write_images(ims.select("filename", file_of("g", F.element_at("g", 1) < DARK_FIRST)), img)
    mask = F.transform("g", lambda v: F.when(v >= MASK_LEVEL, v).otherwise(0))
    im.write_images(ims.where(~F.col("label").eqNullSafe(NO_MASK))
                    .select("filename", file_of(mask, F.element_at("g", -1) > BRIGHT_LAST)), lbl)
    images, masks = im.scan_images(spark, img, named=True), im.scan_images(spark, lbl, named=True)
    pairs = im.pair_with_masks(rx.mask_sum_filter(images, masks), masks)
    return pairs.groupBy("filename").agg(F.count(F.lit(1)).alias("pixels"), F.sum("v").alias("grey_sum"), F.sum("mask").alias("mask_sum"))
