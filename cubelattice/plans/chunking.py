"""Splits a cube request into chunks of at most ``CELLS`` cells. Metadata-sized, plain Python on the driver.

A selection has one axis per dimension; an axis is a list of groups of options. While a chunk is too
large, the first axis that can be split (time, then county/locality pairs, territory, classification,
unit) is cut into balanced, contiguous parts. If no single cut brings a chunk under the limit, the axis is
cut down to single groups and the next axis is cut as well, so a plan exists for every selection."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from math import prod

# Cells per request, and the order in which kinds of axes are split.
CELLS = 30_000
PRIORITY = {"TEMPORAL": 1, "PAIR": 2, "TERRITORIAL": 3, "CLASSIFICATION": 4, "UNIT_OF_MEASURE": 5}


@dataclass(frozen=True)
class Option:
    ident: int
    label: str
    parent: int | None = None


@dataclass
class Dimension:
    kind: str
    options: list[Option] = field(default_factory=list)


def cell_count(selection: list[list]) -> int:
    """Product of the sizes; nothing selected at all is one cell, an empty dimension makes it none."""
    return prod(len(x) for x in selection)


def enc_query(selection: list[list[int]]) -> str:
    return ":".join(",".join(map(str, x)) for x in selection)


def totals_only(dimension: Dimension) -> list[Option]:
    """Options that say total or have no parent; all of a flat dimension."""
    return [o for o in dimension.options if "total" in o.label.lower() or o.parent is None]


def select(dimensions: list[Dimension], years: tuple[int, int] | None = None, totals: bool = False) -> list[list[Option]]:
    """Options per dimension: years in range (labels without a year stay), totals of classifications."""
    out = []
    for d in dimensions:
        options = d.options
        if d.kind == "TEMPORAL" and years is not None:
            options = [o for o in options if (y := first_year(o.label)) is None or years[0] <= y <= years[1]]
        elif d.kind == "CLASSIFICATION" and totals:
            options = totals_only(d)
        out.append(options)
    return out


def select_first(dimensions: list[Dimension], years: tuple[int, int] | None = None, territories: bool = False, county: int | None = None) -> list[list[Option]]:
    """Options per dimension of a simple request: years in range (labels without a year stay), the first option of
    every other dimension. With ``territories`` all territorial options are taken; with ``county`` that county
    alone, and of localities (options with a parent among the territories) its own."""
    counties = {o.ident for d in dimensions if d.kind == "TERRITORIAL" for o in d.options}
    out = []
    for d in dimensions:
        options = d.options
        if d.kind == "TEMPORAL":
            options = [o for o in options if years is None or (y := first_year(o.label)) is None or years[0] <= y <= years[1]]
        elif d.kind != "TERRITORIAL" or not (territories or county is not None):
            options = options[:1]
        elif county is not None:
            local = any(o.parent in counties for o in options)
            options = [o for o in options if (o.parent == county if local else o.ident == county)]
        out.append(options)
    return out


def select_whole(dimensions: list[Dimension], years: tuple[int, int], totals: bool = False) -> list[list[Option]]:
    """Options per dimension of one request for a whole matrix: years in range (labels without a year go; the first
    option where none is left), the one total of a classification (its first option where none is called so)."""
    out = []
    for d in dimensions:
        options = d.options
        if d.kind == "TEMPORAL":
            options = [o for o in options if (y := first_year(o.label)) is not None and years[0] <= y <= years[1]] or options[:1]
        elif d.kind == "CLASSIFICATION" and totals:
            options = [o for o in options if o.label.lower().startswith("total")][:1] or options[:1]
        out.append(options)
    return out


def first_year(label: str) -> int | None:
    digits = ""
    for c in label:
        digits = digits + c if c.isdecimal() and c.isascii() else ""
        if len(digits) == 4:
            return int(digits)
    return None


def balanced(items: list, parts: int) -> list[list]:
    """Contiguous parts whose sizes differ by one at most."""
    size, extra = divmod(len(items), parts)
    bounds = [0]
    for n in range(parts):
        bounds.append(bounds[-1] + size + (n < extra))
    return [items[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


def plan(kinds: list[str], selection: list[list], limit: int = CELLS, whole: frozenset[int] = frozenset()) -> list[list[list]]:
    """Chunks that tile the selection exactly, none over the limit. Axes in ``whole`` are split only where the others
    cannot be split any more."""
    if not cell_count(selection):
        return []
    order = sorted(range(len(kinds)), key=lambda k: (k in whole, PRIORITY[kinds[k]], k))
    done, work = [], [selection]
    while work:
        chunk = work.pop()
        cells = cell_count(chunk)
        if cells <= limit:
            done.append(chunk)
            continue
        splittable = [k for k in order if len(chunk[k]) > 1]
        free = [k for k in splittable if k not in whole] or splittable
        axis = next((k for k in free if cells // len(chunk[k]) <= limit), free[0])
        rest = cells // len(chunk[axis])
        parts = len(chunk[axis]) if rest > limit else -(-len(chunk[axis]) // (limit // rest))
        work += [[*chunk[:axis], part, *chunk[axis + 1 :]] for part in reversed(balanced(chunk[axis], parts))]
    return done


def county_pairs(counties: list[Option], localities: list[Option]) -> list[tuple[Option, list[Option]]]:
    """Each county with its own localities, by parent; counties without one stay out."""
    own: dict[int | None, list[Option]] = {}
    for x in localities:
        own.setdefault(x.parent, []).append(x)
    return [(c, own[c.ident]) for c in counties if c.ident in own]


def plan_pairs(kinds: list[str], selection: list[list[Option]], county: int, locality: int, limit: int = CELLS) -> list[list[list[Option]]]:
    """Chunks of a matrix by localities: each county alone with its own localities, which stay together; the other
    axes are split as in ``plan``. Localities of no selected county stay out."""
    out = []
    for one, own in county_pairs(selection[county], selection[locality]):
        chunk = [[one] if k == county else own if k == locality else axis for k, axis in enumerate(selection)]
        out += plan(kinds, chunk, limit, frozenset({county, locality}))
    return out


def display_name(level: str, county: str | None = None, years: tuple[int, int] | None = None) -> str:
    """A chunk's name in logs: NAT, COUNTIES or the county; its years; its territory level."""
    place = "NAT" if level == "national" else county or ("COUNTIES" if level == "county" else "NAT")
    span = "ALL" if years is None else str(years[0]) if years[0] == years[1] else f"{years[0]}-{years[1]}"
    return f"{place}-{span}-{level}"


def signature(matrix: str, chunk: list[list[int]]) -> str:
    return hashlib.md5(f"v2|{matrix}|{enc_query(chunk)}".encode()).hexdigest()[:16]


def csv_bytes(chunk: list[list[Option]]) -> int:
    """Estimated response size: mean label bytes of up to 50 samples per axis, separators, 13 per value."""
    line = 2 * len(chunk) + 13
    for axis in chunk:
        sample = axis[:50]
        line += sum(len(o.label.encode()) for o in sample) // max(1, len(sample))
    return line * cell_count(chunk)


def duration(chunks: int, interval: float = 0.75) -> str:
    minutes, seconds = divmod(round(chunks * interval), 60)
    hours, minutes = divmod(minutes, 60)
    return f"~{hours}h {minutes}m" if hours else f"~{minutes}m {seconds}s" if minutes else f"~{seconds}s"


def chunk_rows(matrix: str, dimensions: list[Dimension], years: tuple[int, int] | None = None, totals: bool = False, limit: int = CELLS) -> list[tuple[int, str, int, str]]:
    """(number, hash, cells, query) of each chunk."""
    rows = []
    for n, chunk in enumerate(plan([d.kind for d in dimensions], select(dimensions, years, totals), limit)):
        ids = [[o.ident for o in axis] for axis in chunk]
        rows.append((n, signature(matrix, ids), cell_count(ids), enc_query(ids)))
    return rows
