"""Elements of landed pages: where every tag stands, where its element ends, and blocks around a place.

A page is cut before every '<' and stays one row: nesting and "the nearest before" are worked out on arrays, one number per piece
in Arrow batches, so no piece of markup is shuffled or sorted and a page of any length costs its pieces once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE = "_page"
_HEAD = r"^(</?[a-zA-Z][a-zA-Z0-9]*)"


def cut_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages with a key of the whole row (repeated rows once) and the pieces of their markup."""
    whole = F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in pages.columns])
    return pages.withColumn(PAGE, F.md5(whole)).dropDuplicates([PAGE]).withColumn("_pieces", F.split(html, "(?=<)"))


def _lists(like: pa.Array, values: pa.Array, lengths: np.ndarray) -> pa.Array:
    """One list of so many values per row; NULL where `like` is."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, values, mask=like.is_null() if like.null_count else None)


#: Pieces worked on at a time, or one page where it has more: what numpy needs beside them doesn't grow with the pages of a batch.
_PIECES = 1 << 16


def _runs(lengths: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Places of the pieces of successive pages, and how many each page has."""
    done, first = np.concatenate([[0], np.cumsum(lengths)]), 0
    while first < len(lengths):
        last = max(first + 1, int(np.searchsorted(done, done[first] + _PIECES, "right")) - 1)
        yield slice(done[first], done[last]), lengths[first:last]
        first = last


def _nesting(heads: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces per page, and depth and end (see `tags`; -1 for none) of every piece, given the beginnings of the pieces ('<b', '</b', '' for none)."""
    lengths = pc.fill_null(pc.list_value_length(heads), 0).to_numpy(zero_copy_only=False)
    coded = heads.flatten().dictionary_encode()
    texts, codes = [t.lower() for t in coded.dictionary.to_pylist()], coded.indices.to_numpy(zero_copy_only=False)
    names = {n: i for i, n in enumerate(dict.fromkeys(t.strip("</") for t in texts))}
    shut_of, name_of = np.array([t.startswith("</") for t in texts], bool), np.array([names[t.strip("</")] for t in texts], np.int64)
    some = np.array([t != "" for t in texts], bool)
    depths, ends = np.zeros(len(codes), np.int32), np.full(len(codes), -1, np.int32)
    for places, sizes in _runs(lengths):
        code = codes[places]
        page = np.repeat(np.arange(len(sizes)), sizes)
        at = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        tag = np.flatnonzero(some[code]) if texts else np.zeros(0, np.int64)
        group, shut = (page * len(names) + name_of[code])[tag] if texts else tag, shut_of[code][tag] if texts else tag.astype(bool)
        order = np.argsort(group, kind="stable")
        opened = np.cumsum(np.where(shut, -1, 1)[order])
        first = np.flatnonzero(np.diff(group[order], prepend=-1))
        before = np.concatenate([[0], opened])[first]
        depth = np.zeros(len(tag), np.int64)
        depth[order] = opened - np.repeat(before, np.diff(first, append=len(tag))) + shut[order]
        order = np.lexsort((depth, group))
        this, after = order[:-1], order[1:]
        ended = (group[this] == group[after]) & (depth[this] == depth[after]) & shut[after]
        depths[places][tag], ends[places][tag[this[ended]]] = depth, at[tag[after[ended]]]
    return lengths, depths, ends


def _levels(heads: pa.Array) -> pa.Array:
    """depth and end of the tags of pages."""
    lengths, depths, ends = _nesting(heads)
    values = pa.StructArray.from_arrays([pa.array(depths), pa.array(ends, mask=ends < 0)], ["depth", "end"])
    return _lists(heads, values, lengths)


def _ends(heads: pa.Array) -> pa.Array:
    """end alone: a number per piece, where a struct per piece would take eight times the memory."""
    lengths, _, ends = _nesting(heads)
    return _lists(heads, pa.array(ends, mask=ends < 0), lengths)


def _headed(cut: DataFrame) -> DataFrame:
    """Cut pages with the beginning of every piece that is a tag."""
    return cut.withColumn("_heads", F.transform("_pieces", lambda p: F.regexp_extract(p, _HEAD, 1)))


def _tag(head: Column) -> list[Column]:
    return [F.lower(F.ltrim(head, F.lit("</"))).alias("name"), head.startswith("</").alias("closing")]


def tags(cut: DataFrame) -> DataFrame:
    """page, at (number of the piece), name, closing, depth (elements of that name that are open), end per tag.

    end is the piece of the end tag. An element that is never closed, or can't be, has none; it hides no other element's end.
    """
    levels = F.arrow_udf(_levels, "array<struct<depth:int,end:int>>")
    pieces = _headed(cut).withColumn("_levels", levels("_heads")).select(PAGE, F.posexplode(F.arrays_zip("_pieces", "_heads", "_levels")).alias("at", "p")).where("p._heads <> ''")
    return pieces.select(PAGE, "at", *_tag(F.col("p._heads")), F.regexp_extract("p._pieces", "^(<[^>]*>?)", 1).alias("opening"), "p._levels.depth", "p._levels.end")


def elements(pages: DataFrame, wanted: Callable[[Column], Column], html: str = "html") -> DataFrame:
    """The page's other columns, at, name, opening and text of every element whose opening tag is `wanted`, with what lies within it.

    Text of an element without an end is what stands before the next tag.
    """
    rest = [c for c in pages.columns if c != html]

    def opening(piece: Column, i: Column) -> Column:
        head = F.get("_heads", i)
        tag = F.regexp_extract(piece, "^(<[^>]*>?)", 1)
        return F.when((head != "") & ~head.startswith("</") & wanted(tag), F.struct(i.alias("at"), head.alias("head"), tag.alias("opening")))

    def read(e: Column) -> Column:
        end = F.get("_ends", e["at"])
        inside = F.slice("_pieces", e["at"] + 1, F.coalesce(end - e["at"], F.lit(1)))
        return F.struct(e["at"].alias("at"), e["head"].alias("head"), e["opening"].alias("opening"), F.regexp_replace(F.array_join(inside, ""), "<[^>]*>?", "").alias("text"))

    found = F.array_compact(F.transform("_pieces", opening))
    nested = _headed(cut_pages(pages, html)).withColumn("_ends", F.arrow_udf(_ends, "array<int>")("_heads"))
    return nested.select(*rest, F.explode(F.transform(found, read)).alias("e")).select(*rest, "e.at", F.lower(F.substr("e.head", F.lit(2))).alias("name"), "e.opening", "e.text")


# ---- selectors ----------------------------------------------------------------------------
@dataclass(frozen=True)
class Selector:
    """Elements by id, tag and role. In the id {row} and {cell} stand for numbers, {row} first, and a final * for anything."""

    id: str
    tag: str | None = None
    role: str | None = None

    @property
    def pattern(self) -> str:
        body, rest = (self.id[:-1], ".*") if self.id.endswith("*") else (self.id, "")
        for name in ("row", "cell"):
            if body.count(f"{{{name}}}") != 1 and not (name == "cell" and "{cell}" not in body):
                raise ValueError(f"a selector names {{row}} once and {{cell}} once at most: {self.id}")
        parts = re.split(r"\{(row|cell)\}", body)
        if parts[1] != "row":
            raise ValueError(f"a selector names {{row}} before {{cell}}: {self.id}")
        return "^" + "".join("([0-9]+)" if i % 2 else re.escape(p) for i, p in enumerate(parts)) + rest + "$"

    def row(self, element_id: Column) -> Column:
        """Row that an id names; NULL where it doesn't fit."""
        return F.nullif(F.regexp_extract(element_id, self.pattern, 1), F.lit(""))

    def cell(self, element_id: Column) -> Column:
        """Cell number that an id names; NULL where it doesn't fit, or the selector has none."""
        return F.regexp_extract(element_id, self.pattern, 2).try_cast("int") if "{cell}" in self.id else F.lit(None).cast("int")

    def fits(self, element: Column) -> Column:
        """Whether a struct with ids (see `id_patterns`), name and role is one of them; never NULL."""
        out = element["ids"][self.pattern]
        if self.tag is not None:
            out = out & (element["name"] == self.tag.lower())
        if self.role is not None:
            out = out & (element["role"] == self.role)
        return F.coalesce(out, F.lit(False))


def id_patterns(selectors: Iterable[Selector], element_id: Column) -> Column:
    """A flag per id pattern of the selectors, so that each is tried once however many selectors have it."""
    patterns = dict.fromkeys(s.pattern for s in selectors)
    return F.struct(*[F.rlike(element_id, F.lit(p)).alias(p) for p in patterns])


def with_id(selectors: Iterable[Selector]) -> Callable[[Column], Column]:
    """Whether an opening tag has an id that one of the selectors names."""
    ids = "|".join(dict.fromkeys(s.pattern[1:-1] for s in selectors))
    return lambda opening: F.rlike(opening, F.lit(rf"""(?i)[\s"']id\s*=\s*["']?(?:{ids})(?=["'\s>])"""))


def any_fits(selectors: Iterable[Selector], element: Column) -> Column:
    out = F.lit(False)
    for s in selectors:
        out = out | s.fits(element)
    return out


# ---- blocks around a place ----------------------------------------------------------------
@dataclass(frozen=True)
class BlockLocator:
    """Block of a link: from the nearest anchor before it, grown to its row or table.

    An anchor is a piece of text within a tag, else (where none stands before the link) the nearest tag that has the marker,
    else the place `look_behind` characters before the link. Where the row or table has no beginning or end, the block reaches
    `look_behind` characters back, or `look_ahead` on.
    """

    anchors: tuple[str, ...]
    marker: str
    expand: str = "table"
    look_behind: int = 1200
    look_ahead: int = 1600

    def __post_init__(self) -> None:
        if self.expand not in ("row", "table"):
            raise ValueError(f"a block is a row or a table, not {self.expand}")


_MARKS = ("tr", "table", "tr_end", "table_end", "a_end", "link", "marked")


def _placed(locator: BlockLocator) -> Callable[[pa.Array, pa.Array, pa.Array], pa.Array]:
    """Piece, place in it and length of links and of their blocks, given size, marks (bits as in `_MARKS`) and place of an anchor (from 1) of every piece."""

    def nearest(places: np.ndarray, at: np.ndarray, after: bool) -> np.ndarray:
        """The last of `places` up to each `at`, or the first from it on; NaN where there is none."""
        i = np.searchsorted(places, at, "left" if after else "right") - (not after)
        some = (i >= 0) & (i < len(places))
        return np.where(some, np.append(places, 0)[np.where(some, i, -1)], np.nan)

    def first(*choices: np.ndarray) -> np.ndarray:
        out = choices[0]
        for c in choices[1:]:
            out = np.where(np.isnan(out), c, out)
        return out

    def blocks(of: dict[str, np.ndarray], place: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Bounds of the blocks around places, from the nearest beginnings up to `at` and ends from there on."""
        tr, table = (nearest(of[n], at, False) for n in ("tr", "table"))
        tr_end, table_end = (nearest(of[n], at, True) + len(end) for n, end in (("tr_end", "</tr>"), ("table_end", "</table>")))
        if locator.expand == "row":
            return np.array([first(tr, table, np.zeros(len(place))), first(tr_end, table_end, place + locator.look_ahead)])
        return np.array([first(table, np.maximum(place - locator.look_behind, 0)), first(table_end, place + locator.look_ahead)])

    def page(size: np.ndarray, marks: np.ndarray, anchored: np.ndarray) -> np.ndarray:
        offset = np.cumsum(size) - size
        of = {n: offset[(marks >> i) & 1 == 1] for i, n in enumerate(_MARKS)}
        links, anchor = of["link"], offset[anchored > 0]
        far = np.maximum(links - locator.look_behind, 0)
        found = blocks(of, far, links - locator.look_behind)
        for at, place in ((of["marked"], of["marked"]), (anchor, anchor + anchored[anchored > 0] - 1)):
            before = np.searchsorted(at, links, "left") - 1
            if len(at):
                found = np.where(before >= 0, blocks(of, place, at)[:, before], found)
        whole = size.sum()
        links_end = first(nearest(of["a_end"], links, True) + len("</a>"), np.full(len(links), whole))
        bounds = np.minimum(np.array([links, links_end, *found]), whole).astype(np.int64)
        piece = np.searchsorted(offset, bounds, "right") - 1
        out = [[piece[i], bounds[i] - offset[piece[i]], piece[i + 1], bounds[i + 1] - bounds[i]] for i in (0, 2)]
        return np.array([*out[0], *out[1]]).astype(np.int32)

    def placed(sizes: pa.Array, marks: pa.Array, anchored: pa.Array) -> pa.Array:
        lengths = pc.fill_null(pc.list_value_length(sizes), 0).to_numpy(zero_copy_only=False)
        flat = [a.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for a in (sizes, marks, anchored)]
        ends = np.cumsum(lengths)
        found = [page(*(a[end - n : end] for a in flat)) if n else np.zeros((8, 0), np.int32) for end, n in zip(ends, lengths)]
        values = np.concatenate(found, axis=1) if found else np.zeros((8, 0), np.int32)
        names = ("piece", "start", "last", "length")
        parts = [pa.StructArray.from_arrays([pa.array(v) for v in values[i : i + 4]], names) for i in (0, 4)]
        return _lists(sizes, pa.StructArray.from_arrays(parts, ["link", "block"]), np.array([f.shape[1] for f in found], np.int64))

    return placed


def located_links(pages: DataFrame, link: str, locator: BlockLocator, html: str = "html") -> DataFrame:
    """The page's other columns, pos, link and block (markup both) of every link whose opening tag fits a pattern, in page order."""
    rest = [c for c in pages.columns if c != html]
    ends = {n: rf"(?i)^<{'/' + n[:-4] if n.endswith('_end') else n}(?=[\s>/])" for n in _MARKS[:5]}
    fits = [*ends.values(), link, locator.marker]

    def marks(piece: Column) -> Column:
        flags = [F.rlike(piece, F.lit(p)).cast("int") * 2**i for i, p in enumerate(fits)]
        return sum(flags[1:], flags[0])

    part = "struct<piece:int,start:int,last:int,length:int>"
    placed = F.arrow_udf(_placed(locator), f"array<struct<link:{part},block:{part}>>")
    cut = cut_pages(pages, html).select(
        *rest, "_pieces", F.transform("_pieces", F.length).alias("_sizes"), F.transform("_pieces", marks).alias("_marks"),
        F.transform("_pieces", lambda p: F.greatest(*[F.locate(a, p) for a in locator.anchors], F.lit(0), F.lit(0))).alias("_anchored"),
    )

    def read(x: Column) -> Column:
        inside = F.slice("_pieces", x["piece"] + 1, F.greatest(x["last"] - x["piece"], F.lit(0)) + 1)
        return F.substr(F.array_join(inside, ""), x["start"] + 1, F.greatest(x["length"], F.lit(0)))

    both = lambda x: F.struct(read(x["link"]).alias("link"), read(x["block"]).alias("block"))
    return cut.withColumn("_links", placed("_sizes", "_marks", "_anchored")).select(*rest, F.posexplode(F.transform("_links", both)).alias("pos", "x")).select(*rest, "pos", "x.*")
