"""Folds over the pages of a chart, where each step needs what the steps before decided.

Rows are dealt by chart and sorted, and one pass in Python goes over a partition's charts one after another; a chart a call of a grouped
function would cost a fixed overhead for each of very many small charts. What is held is one chart's rows (continuity() holds
none at all: it is a running fold, so a chart of any length will do).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

_TYPES = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, _TYPES[t]) for n, t in (x.strip().split(" ") for x in ddl.split(","))])


def _batches(rows, schema: pa.Schema, size: int = 20_000):
    held = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def running(df: DataFrame, columns: list[str], order: list[str], ddl: str, start, step) -> DataFrame:
    """One row out for each row in, with a state that begins anew at each chart. step(state, row) returns (state, row out)."""
    schema = _schema(ddl)

    def run(batches):
        def rows():
            chart, state = object(), None
            for b in batches:
                for r in zip(*(c.to_pylist() for c in b.columns)):
                    if r[0] != chart:
                        chart, state = r[0], start()
                    state, out = step(state, r)
                    yield out

        yield from _batches(rows(), schema)

    return df.select("chart", *columns).repartition("chart").sortWithinPartitions("chart", *order).mapInArrow(run, ddl)


def per_chart(df: DataFrame, columns: list[str], order: list[str], ddl: str, fold) -> DataFrame:
    """Rows that fold(chart, rows) gives for each chart, its rows in order."""
    schema = _schema(ddl)

    def run(batches):
        def rows():
            chart, held = None, []
            for b in batches:
                for r in zip(*(c.to_pylist() for c in b.columns)):
                    if held and r[0] != chart:
                        yield from fold(chart, held)
                        held = []
                    chart = r[0]
                    held.append(r[1:])
            if held:
                yield from fold(chart, held)

        yield from _batches(rows(), schema)

    return df.select("chart", *columns).repartition("chart").sortWithinPartitions("chart", *order).mapInArrow(run, ddl)


def continuity(gaps: DataFrame, chart: str = "long") -> DataFrame:
    """(chart, page_no, document, start_reason): left to right, with the open document's date. gaps: (chart, page_no, kind, dos string, score): a
    page's score against the page before it, above 0 for a break. Two dates that differ break whatever the score; junk pages join and
    leave the open date as it is; blank pages join."""

    def step(state, row):
        (doc, open_dos), (c, page, kind, dos, score) = state, row
        if doc == 0:
            new, why = True, "first"
        elif kind != "main":
            new, why = False, "attached"
        elif dos and open_dos and dos != open_dos:
            new, why = True, "date"
        elif dos and open_dos:
            new, why = False, "same date"
        else:
            new, why = (score or 0) > 0, "score"
        if new:
            doc, open_dos = doc + 1, None
        if kind == "main" and dos and open_dos is None:
            open_dos = dos
        return (doc, open_dos), (c, page, doc, why)

    return running(gaps, ["page_no", "kind", "dos", "score"], ["page_no"], f"chart {chart}, page_no long, document long, start_reason string", lambda: (0, None), step)


def final_pass(documents: DataFrame, chart: str = "long", passes: int = 3) -> DataFrame:
    """(chart, document, merged): neighbouring documents of one type and date merge, a lone page joins the one before it of its type; passes at most."""

    def fold(c, rows):
        d = [[kind, dos, pages, [doc]] for doc, kind, dos, pages in rows]
        for _ in range(passes):
            out = []
            for x in d:
                p = out[-1] if out else None
                if p and x[0] == p[0] and (x[1] == p[1] or x[2] == 1):
                    p[2] += x[2]
                    p[3] = p[3] + x[3]
                else:
                    out.append(list(x))
            if len(out) == len(d):
                break
            d = out
        return [(c, m, i + 1) for i, x in enumerate(d) for m in x[3]]

    return per_chart(documents, ["document", "kind", "dos", "pages"], ["document"], f"chart {chart}, document long, merged long", fold)


def packets(documents: DataFrame, chart: str = "long", most_pages: int = 8) -> DataFrame:
    """(chart, document, packet): a short document that its last page decides takes the documents before it, up to most_pages."""

    def fold(c, rows):
        stack: list[list] = []
        for doc, pages, by_last in rows:
            own = [[doc], pages]
            while by_last and stack and stack[-1][1] + own[1] <= most_pages:
                p = stack.pop()
                own = [p[0] + own[0], p[1] + own[1]]
            stack.append(own)
        return [(c, m, i + 1) for i, (ms, _) in enumerate(stack) for m in ms]

    return per_chart(documents, ["document", "pages", "by_last_page"], ["document"], f"chart {chart}, document long, packet long", fold)


def streams(markers: DataFrame, chart: str = "long", least: int = 2) -> DataFrame:
    """(chart, page_no, stream): marked pages by their total; where two claim a number, parallel streams, each page to the one whose last
    page is nearest. Totals with fewer than least pages have no stream."""

    def fold(c, rows):
        by_total: dict = {}
        for page, num, total in rows:
            by_total.setdefault(total, []).append((page, num))
        out, n = [], 0
        for _, own in sorted(by_total.items()):
            open_: list[dict] = []
            for page, num in own if len(own) >= least else ():
                fit = [s for s in open_ if num not in s["nums"]]
                s = min(fit, key=lambda s: (abs(page - s["last"]), s["id"])) if fit else None  # noqa: B023
                if s is None:
                    n += 1
                    s = {"id": n, "nums": set(), "last": 0}
                    open_.append(s)
                s["nums"].add(num)
                s["last"] = page
                out.append((c, page, s["id"]))
        return out

    return per_chart(markers, ["page_no", "num", "total"], ["page_no"], f"chart {chart}, page_no long, stream long", fold)


def chain_order(pairs: DataFrame, pages: DataFrame, chart: str = "long", least: float = 0.0) -> DataFrame:
    """(chart, page_no, new_no): pages chained greedily by their best follower. pairs: (chart, a, b, score), pages within a few places."""
    from pyspark.sql import functions as F

    both = pairs.where(F.col("score") > least).select("chart", "a", "b", F.col("score").cast("double").alias("score"))
    both = both.unionByName(pages.select("chart", F.col("page_no").alias("a"), F.lit(None).cast("long").alias("b"), F.lit(None).cast("double").alias("score")))

    def fold(c, rows):
        nxt: dict[int, int] = {}
        head: dict[int, int] = {}

        def top(x):
            while x in head:
                x = head[x]
            return x

        for a, b, _ in sorted((r for r in rows if r[2] is not None), key=lambda r: (-r[2], r[0], r[1])):
            if a not in nxt and b not in head and top(a) != b:
                nxt[a], head[b] = b, a
        order = []
        for p in sorted(r[0] for r in rows if r[2] is None):
            if p not in head:  # the first of a chain, with all that follow
                while p is not None:
                    order.append(p)
                    p = nxt.get(p)
        return [(c, p, i + 1) for i, p in enumerate(order)]

    return per_chart(both, ["a", "b", "score"], ["a"], f"chart {chart}, page_no long, new_no long", fold)
