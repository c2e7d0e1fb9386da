"""Planner, cursor codec, queue, pacing: plain Python."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as s

from cubelattice.plans import chunking as c
from cubelattice.plans import paging
from cubelattice.plans.queue import Chunk, Queue
from cubelattice.sources.fetcher import RateLimited, Response, pivot_request

KINDS = list(c.PRIORITY)


@settings(max_examples=60, deadline=None)
@given(s.lists(s.tuples(s.sampled_from(KINDS), s.integers(1, 60)), min_size=1, max_size=4), s.integers(1, 500))
def test_chunks_tile_the_selection(axes, limit):
    kinds = [k for k, _ in axes]
    selection = [[100 * n + v for v in range(size)] for n, (_, size) in enumerate(axes)]
    chunks = c.plan(kinds, selection, limit)
    assert all(c.cell_count(x) <= limit for x in chunks)
    assert sum(map(c.cell_count, chunks)) == c.cell_count(selection)
    if c.cell_count(selection) <= 3000:
        from itertools import product

        cells = [cell for x in chunks for cell in product(*x)]
        assert len(set(cells)) == len(cells) and set(cells) == set(product(*selection))
    assert chunks == c.plan(kinds, selection, limit)


def test_time_is_split_first_into_balanced_parts():
    chunks = c.plan(["CLASSIFICATION", "TEMPORAL"], [list(range(1000)), list(range(100))], 30_000)
    assert [len(x[1]) for x in chunks] == [25] * 4 and all(len(x[0]) == 1000 for x in chunks)


def test_two_axes_are_split_when_one_is_not_enough():
    assert all(c.cell_count(x) <= 30_000 for x in c.plan(["TEMPORAL", "CLASSIFICATION"], [list(range(3)), list(range(100_000))]))


def test_counts_queries_and_estimates():
    assert c.cell_count([]) == 1 and c.cell_count([[1], []]) == 0 and c.plan(["TEMPORAL"], [[]]) == []
    assert c.cell_count([list(range(30_000))]) == c.CELLS and len(c.plan(["TEMPORAL"], [list(range(30_000))])) == 1
    assert c.enc_query([[1, 2], [3]]) == "1,2:3"
    assert c.duration(10) == "~8s" and c.duration(200) == "~2m 30s" and c.duration(6000) == "~1h 15m"
    assert len(c.signature("X", [[1]])) == 16 and c.signature("X", [[1]]) != c.signature("Y", [[1]])
    options = [c.Option(1, "Total"), c.Option(2, "A", 1), c.Option(3, "Anul 1999", 1)]
    assert c.csv_bytes([options]) > 0 and c.first_year("Anul 1999") == 1999 and c.first_year("199") is None
    assert c.totals_only(c.Dimension("CLASSIFICATION", options)) == options[:1]
    assert c.select([c.Dimension("TEMPORAL", options)], (2000, 2001)) == [options[:2]]
    counties = [c.Option(10, "A"), c.Option(11, "B")]
    assert c.county_pairs(counties, [c.Option(20, "x", 10)]) == [(counties[0], [c.Option(20, "x", 10)])]


def test_whole_matrix_selection_names_and_pairs():
    times = c.Dimension("TEMPORAL", [c.Option(n, f"Anul {1990 + n}") for n in range(5)] + [c.Option(9, "Total")])
    kinds = c.Dimension("CLASSIFICATION", [c.Option(20, "A"), c.Option(21, "TOTAL general"), c.Option(22, "total")])
    plain = c.Dimension("CLASSIFICATION", [c.Option(30, "x"), c.Option(31, "y")])
    ids = lambda found: [[o.ident for o in axis] for axis in found]
    assert ids(c.select_whole([times, kinds, plain], (1991, 1992), True)) == [[1, 2], [21], [30]]
    assert ids(c.select_whole([times, kinds, plain], (2050, 2051))) == [[0], [20, 21, 22], [30, 31]]
    counties = c.Dimension("TERRITORIAL", [c.Option(50, "Alba"), c.Option(51, "Arad")])
    places = c.Dimension("TERRITORIAL", [c.Option(60, "a", 50), c.Option(61, "b", 51), c.Option(62, "c", 51)])
    assert ids(c.select_first([times, kinds, counties], (1991, 1991))) == [[1, 9], [20], [50]]
    assert ids(c.select_first([kinds, counties], territories=True)) == [[20], [50, 51]]
    assert ids(c.select_first([times, counties, places], (1994, 1999), county=51)) == [[4, 9], [51], [61, 62]]
    assert c.display_name("national") == "NAT-ALL-national" and c.display_name("county", None, (2000, 2004)) == "COUNTIES-2000-2004-county"
    assert c.display_name("uat", "CJ", (2020, 2020)) == "CJ-2020-uat" and c.display_name("uat") == "NAT-ALL-uat"
    counties = [c.Option(n, f"county {n}") for n in range(3)]
    places = [c.Option(100 * n + k, "place", n) for n in (0, 2) for k in range(40)] + [c.Option(999, "lost", 77)]
    chunks = c.plan_pairs(["TEMPORAL", "TERRITORIAL", "TERRITORIAL"], [list(range(30)), counties, places], 1, 2, 400)
    assert all(c.cell_count(x) <= 400 and len(x[1]) == 1 and len(x[2]) == 40 for x in chunks)
    assert sorted((x[1][0].ident, t) for x in chunks for t in x[0]) == [(n, t) for n in (0, 2) for t in range(30)]
    tight = c.plan_pairs(["TEMPORAL", "TERRITORIAL", "TERRITORIAL"], [[1], counties, places], 1, 2, 25)
    assert all(c.cell_count(x) <= 25 for x in tight) and sum(map(c.cell_count, tight)) == 80


@given(s.one_of(s.none(), s.text(), s.integers(), s.floats(allow_nan=False)), s.integers())
def test_cursor_round_trip(value, ident):
    assert paging.decode_cursor(paging.encode_cursor(value, ident)) == {"sortValue": value, "id": ident, "direction": "forward"}


@pytest.mark.parametrize("bad", [None, "", "%%%", "bm90IGpzb24", "W10", "e30"])
def test_malformed_cursors_are_ignored(bad):
    assert paging.decode_cursor(bad) is None


@pytest.mark.parametrize(("value", "wanted"), [(None, 50), ("x", 50), (0, 50), (-3, 50), ("7", 7), (501, 500), (500, 500)])
def test_limits(value, wanted):
    assert paging.parse_limit(value) == wanted


def test_pages_carry_a_cursor_only_if_more_follow():
    rows = [{"n": k, "id": k} for k in range(3)]
    shown, cursor = paging.cut_page(rows, 2, "n", "id")
    assert len(shown) == 2 and paging.decode_cursor(cursor)["id"] == 1
    assert paging.cut_page(rows, 3, "n", "id")[1] is None


def test_task_life():
    q = Queue()
    low, new = q.submit("A", (2000, 2001), 0.0)
    assert new and q.submit("A", (2000, 2001), 5.0) == (low, False)
    high, _ = q.submit("B", (2000, 2001), 9.0, priority=4)
    assert q.claim(10.0).task_id == high.task_id
    q.start(high.task_id, 10.0)
    assert q.release_stale(20.0) == 0 and q.release_stale(311.0) == 1
    assert q.claim(312.0).task_id == high.task_id
    assert q.finish(high.task_id, "x" * 2000).status == "FAILED" and len(q.tasks[1].error) == 1000
    assert q.retry(high.task_id) and q.cancel(high.task_id) and not q.cancel(high.task_id)
    assert q.finish(q.claim(400.0).task_id).status == "COMPLETED" and q.claim(401.0) is None


def test_chunks_back_off_and_give_up():
    q = Queue(chunks={"a": Chunk("a")})
    waits = []
    now = 0.0
    for _ in range(3):
        assert q.claim_chunk(now).status == "IN_PROGRESS"
        failed = q.fail_chunk("a", "timeout", now)
        waits.append(failed.next_retry and failed.next_retry - now)
        now = failed.next_retry or now
    assert waits == [2.0, 4.0, None] and q.chunks["a"].status == "EXHAUSTED" and q.claim_chunk(1e9) is None
    q.chunks["b"] = Chunk("b")
    q.claim_chunk(0.0)
    assert q.fail_chunk("b", "Matrix NOT FOUND", 0.0).status == "EXHAUSTED"
    q.chunks["c"] = Chunk("c")
    q.claim_chunk(0.0)
    q.complete_chunk("c")
    assert q.chunks["c"].status == "COMPLETED"


def test_pace_and_retries():
    now, slept = [0.0], []

    def sleep(x):
        slept.append(round(x, 3))
        now[0] += x

    answers = [Response(429, "", {"Retry-After": "2"}), Response(429, "", {}), Response(200, "ok", {}), Response(200, "ok", {})]
    call = RateLimited(lambda url: answers.pop(0), clock=lambda: now[0], sleep=sleep)
    assert call("u").body == "ok" and slept == [2.0, 3.0]
    call("u")
    assert slept[-1] == 0.75
    assert RateLimited(lambda url: Response(429, "", {}), clock=lambda: now[0], sleep=sleep)("u").status == 429
    assert pivot_request([[1, 2], [3]], "X")["encQuery"] == "1,2:3"
