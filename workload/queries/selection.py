"""Search, selection and pages."""

from ddlscope.fixed import PAGE_SIZES
from ddlscope.functions.text import search_matches
from ddlscope.functions.text import listing_order
from ddlscope.operators import paging, ranked, selection
from ddlscope.session import scratch_path
from workload.registry import query
from workload.sql import KEYS, SELECTED

SIZE = PAGE_SIZES[0]
_FOUND = "contains(lower(schema_name || '.' || object_name || ' ' || kind), 'bolt_')"
_PAGED = f"""
paged AS (
  SELECT *, CAST(floor((position - 1) / {SIZE}) AS BIGINT) AS page,
    CAST(greatest(ceil(matches / {SIZE}), 1) AS BIGINT) AS pages FROM (
      SELECT *, row_number() OVER (PARTITION BY catalog_name ORDER BY schema_name, lower(object_name), object_name) AS position,
        count(*) OVER (PARTITION BY catalog_name) AS matches FROM selected_objects))"""
# A page beyond the end means the last one.
_THIRD = "page = least(2, pages - 1)"


def objects(t):
    return selection.with_selection(t("fx_ddl"), t("fx_selection"))


def pages(t):
    return paging.paginate(objects(t).drop("ddl"), SIZE)


@query("SELECT catalog_name, schema_name, object_name, kind FROM fx_ddl "
       "WHERE contains(lower(schema_name || '.' || object_name || ' ' || kind), '9 tab')")
def f5_search(t):
    return selection.matches(t("fx_ddl"), " 9 TAB ").drop("ddl")


@query(f"WITH {SELECTED} SELECT {KEYS} FROM selected_objects WHERE selected AND length(ddl) > 0")
def f6_to_export(t):
    return selection.to_export(objects(t)).select("catalog_name", "schema_name", "object_name")


@query(f"WITH {SELECTED} SELECT {KEYS} FROM selected_objects WHERE selected AND ddl IS NULL")
def f7_to_generate(t):
    return selection.to_generate(objects(t)).select("catalog_name", "schema_name", "object_name")


@query(f"WITH {SELECTED} SELECT * FROM selected_objects")
def j3_selection(t):
    return objects(t)


@query(f"""WITH {SELECTED}, {_PAGED} SELECT catalog_name, schema_name, count(*) FILTER (selected) AS selected, count(*) AS total
           FROM selected_objects WHERE (catalog_name, schema_name) IN
             (SELECT (catalog_name, schema_name) FROM paged WHERE {_THIRD}) GROUP BY ALL""")
def j12_page_schema_counts(t):
    return selection.page_schema_counts(objects(t), paging.one_page(objects(t).drop("ddl"), 2, SIZE))


@query(f"""WITH {SELECTED} SELECT catalog_name, count(*) FILTER (selected) AS selected, count(*) AS total
           FROM selected_objects GROUP BY ALL""")
def a1_selection_counts(t):
    return selection.selection_counts(objects(t))


@query(f"""WITH {SELECTED} SELECT catalog_name, schema_name, count(*) FILTER (selected) AS selected, count(*) AS total
           FROM selected_objects GROUP BY ALL""")
def a2_schema_counts(t):
    return selection.schema_counts(objects(t))


@query(f"""WITH {SELECTED}, {_PAGED} SELECT {KEYS}, kind, selected, position, matches, page, pages,
             page * {SIZE} + 1 AS first_row, least(page * {SIZE} + {SIZE}, matches) AS last_row FROM paged""")
def w1_pages(t):
    return pages(t)


@query(f"WITH {SELECTED}, {_PAGED} SELECT {KEYS}, kind, position, page FROM paged WHERE {_THIRD}")
def w1_third_page(t):
    third = paging.one_page(objects(t).drop("ddl"), 2, SIZE)
    return third.select("catalog_name", "schema_name", "object_name", "kind", "position", "page")


@query(f"WITH {SELECTED}, {_PAGED} SELECT {KEYS}, kind, position FROM paged WHERE page = pages - 1")
def w1_last_page(t):
    # An index beyond the last page shows the last one.
    return pages(t).where(paging.on_page(1 << 40)).select("catalog_name", "schema_name", "object_name", "kind", "position")


def stored(t):
    """The listing of each catalog in order, with its directory, in parts of some hundred rows."""
    rows = objects(t).drop("ddl")
    return ranked.store(rows, scratch_path(t.spark, "ranked"), listing_order(), ["catalog_name"], ["schema_name", "object_name"])


@query(f"WITH {SELECTED}, {_PAGED} SELECT {KEYS}, kind, selected, position, matches FROM paged")
def w1_stored_positions(t):
    return stored(t).positions(total="matches")


@query(f"WITH {SELECTED}, {_PAGED} SELECT {KEYS}, kind, selected, position, page FROM paged WHERE {_THIRD}")
def w1_stored_third_page(t):
    return stored(t).page(2, SIZE)


@query(f"WITH {SELECTED}, {_PAGED} SELECT {KEYS}, kind, selected, position, page FROM paged WHERE page = pages - 1 AND catalog_name = 'main'")
def w1_stored_last_page_of_one(t):
    return stored(t).page_of(["main"], 1 << 40, SIZE)


@query(f"""WITH counted AS (SELECT c.catalog_name, coalesce(m.matches, 0) AS matches
             FROM (SELECT DISTINCT catalog_name FROM fx_describe) c LEFT JOIN (
               SELECT catalog_name, count(*) AS matches FROM fx_ddl WHERE {_FOUND} GROUP BY ALL) m USING (catalog_name)),
           paged AS (SELECT *, CAST(greatest(ceil(matches / {SIZE}), 1) AS BIGINT) AS pages FROM counted)
           SELECT catalog_name, matches, pages, least(1, pages - 1) AS page,
             CASE WHEN matches > 0 THEN least(1, pages - 1) * {SIZE} + 1 ELSE 0 END AS first_row,
             least(least(1, pages - 1) * {SIZE} + {SIZE}, matches) AS last_row FROM paged""")
def w1_page_summary(t):
    return paging.page_summary(t("fx_describe"), selection.matches(t("fx_ddl"), "bolt_"), 1, SIZE)


@query(f"WITH {SELECTED}, {_PAGED} SELECT {KEYS}, selected OR {_THIRD} AS selected FROM paged")
def w5_select_page(t):
    return selection.select_where(pages(t), paging.on_page(2))


@query(f"WITH {SELECTED} SELECT {KEYS}, selected OR {_FOUND} AS selected FROM selected_objects")
def w5_select_matches(t):
    return selection.select_where(objects(t), search_matches("bolt_"))


@query(f"WITH {SELECTED} SELECT {KEYS}, selected AND NOT {_FOUND} AS selected FROM selected_objects")
def w5_deselect_matches(t):
    return selection.select_where(objects(t), search_matches("bolt_"), False)
