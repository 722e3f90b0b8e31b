"""Periodic runs of words: string synchronising sets at dyadic scales (Kempa and Kociumaka, 2019).

At scale ``tau`` a position is chosen when the least hash among the windows of ``tau`` words that begin at it or at the
``tau`` positions after it belongs to the first or the last of them. The choice depends on the next ``2 tau`` words
only, so the positions chosen in a run repeat with its period, and two neighbours of equal context propose it. Windows
with a period of ``tau / 4`` or less are no candidates, which keeps the set sparse; their periods were found at smaller
scales, and those runs are what marks the windows here.

A run of smallest period ``q`` and at least ``4 q`` words has chosen positions ``q`` apart at the scale with
``tau <= q < 2 tau``, never more than ``tau`` words between them; less than ``tau`` words are left on either side, which
are compared word by word. So no run is missed, and each is proposed with its smallest period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.spans import split_words
from tidemark.llm.text import mix, slices

#: Periods that a run holds at least, and words that it has at least to be reported.
EXPONENT, LEAST_WORDS = 4, 6
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _ahead(values: np.ndarray, by: int) -> np.ndarray:
    """``values`` from ``by`` places further on; what lies beyond the end repeats and is never used."""
    out = np.empty_like(values)
    out[:len(values) - by] = values[by:]
    out[len(values) - by:] = values[-1:]
    return out


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of ``size + 1`` values from each place on, ``size`` being a power of two."""
    out, step = values, 1
    while step < size:
        out = np.minimum(out, _ahead(out, step))
        step *= 2
    return np.minimum(out, _ahead(values, size))


def _same_ahead(ids: np.ndarray, at: np.ndarray, limit: np.ndarray, period: np.ndarray, step: int, tau: int) -> np.ndarray:
    """How many words from ``at`` on, in direction ``step`` and at most ``limit``, equal those a period further on."""
    total = np.zeros(len(at), np.int64)
    live = np.arange(len(at))
    while len(live):
        ahead = np.arange(tau) + total[live, None]
        inside = ahead < limit[live, None]
        place = np.where(inside, at[live, None] + step * ahead, at[live, None])
        place = np.clip(place, 0, len(ids) - 1)
        same = inside & (ids[place] == ids[np.minimum(place + period[live, None], len(ids) - 1)])
        whole = same.all(1)
        total[live] += np.where(whole, tau, same.argmin(1))
        live = live[whole]
    return total


def find_runs(ids: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of ``EXPONENT`` periods or more in the texts that ``edges`` cut ``ids`` into.

    A run is a longest stretch of its smallest period. They come by start, then period; starts count over all texts.
    """
    found = np.zeros((0, 3), np.int64)
    place = np.arange(len(ids))
    sizes = np.diff(edges)
    window = mix(ids.astype(np.uint64) + np.uint64(1))
    tau = 1
    while True:
        fits = sizes >= EXPONENT * tau
        if not fits.any():
            break
        if not fits.all():
            inside = np.repeat(fits, sizes)
            ids, place, window, sizes = ids[inside], place[inside], window[inside], sizes[fits]
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        room = first + np.repeat(sizes, sizes) - np.arange(len(ids))

        key = window
        small = found[(found[:, 2] * 4 <= tau) & (found[:, 1] >= tau)]
        if len(small):
            begin = np.searchsorted(place, small[:, 0])
            known = place[np.minimum(begin, len(place) - 1)] == small[:, 0]
            begin, length = begin[known], small[known, 1]
            steps = np.bincount(begin, minlength=len(ids) + 1) - np.bincount(
                begin + length - tau + 1, minlength=len(ids) + 1)
            key = np.where(np.cumsum(steps[:len(ids)]) > 0, _NONE, window)
        least = _least(key, tau)
        chosen = np.flatnonzero(
            (room >= 2 * tau) & (least != _NONE) & ((key == least) | (_ahead(key, tau) == least)))
        del key, least
        window = mix(window * _LEFT + mix(_ahead(window, tau) + _RIGHT))  # now of 2 tau words

        context = window[chosen]
        order = np.argsort(context, kind="stable")
        context, at = context[order], chosen[order]
        period = at[1:] - at[:-1]
        fine = (context[1:] == context[:-1]) & (period >= tau) & (period < 2 * tau)
        fine[fine] = room[at[:-1][fine]] >= period[fine] + 2 * tau
        at, period = at[:-1][fine], period[fine]
        if len(at):
            order = np.lexsort((at, period))
            at, period = at[order], period[order]
            fresh = np.append(True, (period[1:] != period[:-1]) | (at[1:] - at[:-1] > 2 * tau))
            last = np.append(np.flatnonzero(fresh[1:]), len(at) - 1)
            begin, stop, period = at[fresh], at[last] + period[last] + 2 * tau, period[fresh]
            long = stop - begin + 2 * tau >= EXPONENT * period
            begin, stop, period = begin[long], stop[long], period[long]
        else:
            begin = stop = period = at
        if len(begin):
            left = _same_ahead(ids, begin - 1, begin - first[begin], period, -1, tau)
            right = _same_ahead(ids, stop - period, room[stop - 1] - 1, period, 1, tau)
            begin, stop = begin - left, stop + right
            long = stop - begin >= EXPONENT * period
            runs = np.stack([place[begin[long]], (stop - begin)[long], period[long]], axis=1)
            found = np.concatenate([found, np.unique(runs, axis=0)])
        tau *= 2
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    return found[:, 0], found[:, 1], found[:, 2]


def planted(n: int, h: int) -> np.ndarray | None:
    """Which of ``n`` words stands at each place after the damage of hash ``h``; None where there is none."""
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


def periodic_runs(docs: DataFrame, damage: bool = False) -> DataFrame:
    """(doc_id, runs, collapsed) of every whole text: its runs as (start, length, period) by start, then period, and
    the text without the words that only repeat a run's first period, joined by one space.

    Words are numbered from 0. Runs of fewer than ``LEAST_WORDS`` words are left out. A null text has no words, a
    text without words no runs and an empty collapsed text; repeated rows give repeated results, an empty table none.
    With ``damage`` texts get the periodic tail that :func:`planted` describes, by the crc32 of the id (none where the
    id is null). One text is held whole in a task, at some 100 bytes a word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = batch.column(2).to_pylist()
            for first, last, body, offsets in slices(batch.column(1)):
                words = split_words(body, offsets)
                ids, values, edges = words.ids, words.values, words.edges
                moved = np.arange(len(ids))
                for t in range(last - first):
                    h, n = crc[first + t], int(edges[t + 1] - edges[t])
                    order = planted(n, h) if damage and h is not None else None
                    if order is not None:
                        moved[edges[t]:edges[t + 1]] = edges[t] + order
                if damage:
                    ids, values = ids[moved], values.take(pa.array(moved))
                start, length, period = find_runs(ids, edges)
                shown = length >= LEAST_WORDS
                start, length, period = start[shown], length[shown], period[shown]
                steps = np.bincount(start + period, minlength=len(ids) + 1) - np.bincount(
                    start + length, minlength=len(ids) + 1)
                kept = np.cumsum(steps[:len(ids)]) == 0
                left = np.zeros(len(ids) + 1, np.int32)
                np.cumsum(kept, out=left[1:])
                collapsed = pc.binary_join(
                    pa.ListArray.from_arrays(pa.array(left[edges], pa.int32()), values.filter(pa.array(kept))), b" ")
                owner = np.searchsorted(edges, start, "right") - 1
                bounds = np.searchsorted(owner, np.arange(last - first + 1)).astype(np.int32)
                rows = pa.StructArray.from_arrays(
                    [pa.array(x, pa.int64()) for x in (start - edges[owner], length, period)],
                    names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.ListArray.from_arrays(pa.array(bounds), rows),
                     collapsed.cast(pa.string())], names=["doc_id", "runs", "collapsed"])

    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), crc.alias("crc")).mapInArrow(
        run, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def digest(found: DataFrame) -> DataFrame:
    """Counts, the run of the greatest exponent (ties: first start, then period) and hashes of :func:`periodic_runs`."""
    best = F.expr(
        "array_min(transform(runs, r -> struct(-(cast(r.length as double) / r.period) as e, r.start as start, "
        "r.period as period, r.length as length)))")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
