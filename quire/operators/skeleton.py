"""Contents entries: parsing, hierarchy, offsets, start pages and section placement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators.folds import along, by_document

# Costs of the start page assignment.
SKIP_COST, MAX_OFFSET = 24.0, 128


def toc_entry(line: Column) -> Column:
    """struct(title, page label) of a contents line with a leader or space before the page, else null."""
    line = T.toc_line(line)
    pattern = r"^\s*(.+?)\s*(?:[/.·•…\-\s]+)([0-9]+|[ivxlcdmIVXLCDM]+)\s*$"
    return F.when(line.rlike(pattern), F.struct(T.clean_toc_title(F.regexp_extract(line, pattern, 1)).alias("title"), F.regexp_extract(line, pattern, 2).alias("page_label")))


def toc_pages(pages: DataFrame, lines_needed: int = 2) -> DataFrame:
    """Pages of the contents: the first with a contents title and enough entry lines, and those after it while they have enough.

    pages: doc_id, page, has_title, n_entries.
    """
    w = Window.partitionBy("doc_id").orderBy("page")
    p = pages.withColumn("_start", F.col("has_title") & (F.col("n_entries") >= lines_needed))
    p = p.withColumn("_g", F.sum(F.col("_start").cast("int")).over(w))
    p = p.withColumn("_broken", F.max((F.col("n_entries") < lines_needed).cast("int")).over(Window.partitionBy("doc_id", "_g").orderBy("page")))
    return p.where("_g = 1 AND _broken = 0").select("doc_id", "page")


def agreed_offsets(entries: DataFrame) -> DataFrame:
    """``offset``: that of the nearest located entries before and after of the same role, if they agree.

    entries: doc_id, entry_index, role, printed_page, start_page.
    """
    w = Window.partitionBy("doc_id", "role").orderBy("entry_index")
    own = F.col("start_page") - F.col("printed_page")
    before = F.last(own, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(own, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    return entries.withColumn("offset", F.when(before == after, before))


def prune(entries: DataFrame) -> DataFrame:
    """Candidates between the nearest selected pages before and after."""
    w = Window.partitionBy("doc_id").orderBy("entry_index")
    low = F.coalesce(F.last("start_page", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    high = F.coalesce(F.first("start_page", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)), F.lit(2**31 - 1))
    e = entries.withColumn("_low", low).withColumn("_high", high)
    return e.withColumn("candidates", F.filter("candidates", lambda p: (p >= F.col("_low")) & (p <= F.col("_high")))).drop("_low", "_high")


def _parents(at: list[int], level: list[int], may: list[bool]) -> list[int | None]:
    out: list[int | None] = []
    open_: list[tuple[int, int]] = []
    for i, own, parent in zip(at, level, may, strict=True):
        k = len(open_)
        while k and open_[k - 1][0] >= own:
            k -= 1
        out.append(int(open_[k - 1][1]) if k else None)
        if parent:
            open_[k:] = [(own, i)]
    return out


def hierarchy(entries: DataFrame) -> DataFrame:
    """``parent_index``: the nearest earlier entry of a smaller level, whatever the levels are.

    One pass with a stack of open ancestors. An entry whose ``is_parent``, if there is such a column, is false is no
    parent and closes none.
    """
    may = F.coalesce(F.col("is_parent"), F.lit(True)) if "is_parent" in entries.columns else F.lit(True)
    e = entries.select("doc_id", "entry_index", F.col("entry_index").alias("_i"), "level", may.alias("_may"))
    return entries.join(along(e, "entry_index", ["_i", "level", "_may"], _parents, "bigint", "parent_index"), ["doc_id", "entry_index"], "left")


def monotonic_starts(entries: DataFrame) -> DataFrame:
    """``start_page``: non-decreasing pages of least cost by dynamic programming.

    A skipped entry costs SKIP_COST, a candidate its rank, a change of the
    printed offset within a role its absolute size. Every (page, offset, role)
    state is kept; equal costs go to the path whose first missing entry comes
    later, then to the smaller last page. Entries of a document depend on all
    before; documents stream by in order, and a task holds one document's contents at a time.
    """

    def assign(doc_id: list, entry_index: list, offered: list, printed_page: list, roles: list) -> tuple[list, ...]:
        # (page, offset, role) -> (cost, bits of missing entries with the first on top, (earlier link, position, page))
        states: dict[tuple[int | None, int | None, object], tuple[float, int, tuple | None]] = {(None, None, None): (0.0, 0, None)}
        for at, (candidates, printed, role) in enumerate(zip(offered, printed_page, roles, strict=True)):
            label = None if printed is None or printed != printed else int(printed)
            offers = [(rank, int(p), None if label is None else int(p) - label) for rank, p in enumerate(candidates or [])]
            offers = [(rank, p, own) for rank, p, own in offers if own is None or abs(own) <= MAX_OFFSET]
            step: dict[tuple[int | None, int | None, object], tuple[float, int, tuple | None]] = {}
            for (page, offset, last_role), (cost, missing, link) in states.items():
                key, total, bits = (page, offset, last_role), cost + SKIP_COST, missing << 1 | 1
                kept = step.get(key)
                if kept is None or (total, bits) < kept[:2]:
                    step[key] = (total, bits, link)
                active, bits = offset if last_role == role else None, missing << 1
                for rank, p, own in offers:
                    if page is not None and p < page:
                        continue
                    total = cost + rank + (abs(own - active) if own is not None and active is not None else 0)
                    key = (p, active if own is None else own, role)
                    kept = step.get(key)
                    if kept is None or (total, bits) < kept[:2]:
                        step[key] = (total, bits, (link, at, p))
            states = step
        best: list[int | None] = [None] * len(doc_id)
        link = min(states.items(), key=lambda s: (*s[1][:2], s[0][0] or 0))[1][2]
        while link is not None:
            link, at, page = link
            best[at] = page
        return doc_id, entry_index, best

    kind = entries.schema["doc_id"].dataType.simpleString()
    slim = entries.select("doc_id", "entry_index", "candidates", "printed_page", "role")
    return by_document(slim, [F.asc_nulls_last("entry_index")], assign, f"doc_id {kind}, entry_index long, start_page long")


def boundaries(entries: DataFrame) -> DataFrame:
    """First and last body entry and first back matter entry."""
    at = lambda f, role: f(F.when(F.col("role") == role, F.col("entry_index")))
    return entries.groupBy("doc_id").agg(at(F.min, "body").alias("first_body"), at(F.max, "body").alias("last_body"), at(F.min, "back_matter").alias("first_back"))


def placements(pages: DataFrame, starts: DataFrame) -> DataFrame:
    """``placement`` of every page by the sections that start on it: standalone, start, conflict or none."""
    s = starts.groupBy("doc_id", "page").agg(F.count(F.lit(1)).alias("n_starts"), F.min("section_id").alias("_one"))
    p = pages.join(s, ["doc_id", "page"], "left").withColumn("n_starts", F.coalesce("n_starts", F.lit(0)))
    kind = F.when(F.col("is_standalone"), "standalone").when(F.col("n_starts") == 1, "start").when(F.col("n_starts") > 1, "conflict").otherwise("none")
    return p.select("doc_id", "page", "n_starts", kind.alias("placement"), F.when(kind == "start", F.col("_one")).alias("section_id"))


