"""One ordered pass over a document's units, where a merged row meets the next one (R6-R9 in part).

Built are the joins that texts and page numbers alone decide. Without boxes, page
layout and bridge pages there is no boundary evidence, so a paragraph without a
final mark takes the next page's first one and neighbouring displays are joined
unproven; paragraphs over bridge pages, footnotes of one page, the tail in a
footnote's lane and R10's audit events are missing.

Units: doc_id, ord, unit_type, text, page. A unit's fate depends on what was
merged before it, so each document is one ordered pass; documents stream by, and one
document's units are all that a task holds at a time.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.folds import by_document

_ENDS = frozenset(".!?。！？…:：;；\"'”’」』)）")
_EDGE = r"\s，,。.：:；;、—-"
_DOWN = re.compile(rf"(?:\s*(?:（接下页）|\(接下页\)|【接下页】|\[接下页\])|^接下页|\s+接下页|(?<=[{_EDGE}])接下页)\s*$")
_UP = re.compile(rf"^\s*(?:（接上页）|\(接上页\)|【接上页】|\[接上页\]|接上页(?=$|[{_EDGE}]))\s*")


def _ended(pieces: list[str]) -> bool:
    """Whether a text in pieces ends in a final mark, space aside."""
    ends = (s[-1] for piece in reversed(pieces) if (s := piece.rstrip()))
    return next(ends, None) in _ENDS


def reconcile(units: DataFrame) -> DataFrame:
    """Merged units: doc_id, unit_no, unit_type, text, first_page, last_page, n_merged.

    A paragraph without a terminal mark takes the next page's first paragraph, a
    footnote that ends in a mark for the next page takes the first one there
    that begins with a mark for the page before, whatever lies between, and
    neighbouring displays over a page break are one. Footnotes and figures between the halves
    of a paragraph don't part it. A null text is empty; units with a null page join nothing; very
    long documents are one task's; empty tables give empty tables.
    """

    def run(doc_id: list, _ord: list, unit_type: list, texts: list, pages: list) -> tuple[list, ...]:
        kinds, said, firsts, lasts, merged = [], [], [], [], []  # of the units so far; said has a unit's text in pieces
        last: dict[str, int] = {}
        stop = -1  # the last unit that parts the halves of a paragraph
        going_on: set[int] = set()  # footnotes that end in a mark for the next page
        for kind, text, page in zip(unit_type, texts, pages, strict=True):
            at = last.get(kind)
            up = "接上页" in text and _UP.search(text)
            if up:
                waiting = [k for k in going_on if page is not None and lasts[k] == page - 1]
                if kind == "footnote":
                    at = min(waiting, default=None)
                else:
                    going_on.difference_update(waiting)
            joined = False
            if at is not None and page is not None and lasts[at] is not None and page - lasts[at] == 1:
                if kind == "paragraph" and stop <= at and not _ended(said[at]):
                    joined = True
                    said[at].append(text)
                elif kind == "footnote" and at in going_on and up:
                    joined = True
                    said[at] = [_DOWN.sub("", "".join(said[at])), "\n", _UP.sub("", text)]
                elif kind == "display_block" and at == len(kinds) - 1:
                    joined = True
                    said[at] += ["\n", text]
            if joined:
                lasts[at] = page
                merged[at] += 1
            else:
                at = last[kind] = len(kinds)
                if kind not in ("footnote", "figure"):
                    stop = at
                for column, value in ((kinds, kind), (said, [text]), (firsts, page), (lasts, page), (merged, 1)):
                    column.append(value)
            if kind == "footnote":
                whole = "".join(said[at])
                (going_on.add if "接下页" in whole and _DOWN.search(whole) else going_on.discard)(at)
        n = len(kinds)
        return doc_id[:1] * n, list(range(1, n + 1)), kinds, ["".join(x) for x in said], firsts, lasts, merged

    kind = units.schema["doc_id"].dataType.simpleString()
    slim = units.select("doc_id", "ord", "unit_type", F.coalesce("text", F.lit("")).alias("text"), units["page"].cast("long").alias("page"))
    return by_document(slim, [F.asc_nulls_last("ord")], run, f"doc_id {kind}, unit_no long, unit_type string, text string, first_page long, last_page long, n_merged long")
