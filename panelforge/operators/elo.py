"""Elo sweeps within tasks: a part's teams and their games as arrays, and what they tell the teams' rivals.

Every row is (part, kind, source, data, most). A part holds the teams of one hash; `static` is what the games of a block
are, `ratings` what the blocks before left, `state` the ratings before the games as far as they have settled, and `mail`
the ratings that another part's teams bring to their games against this part's, in the order of the games' numbers.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

ROWS = "part int, kind string, source int, data binary, most double"
RESULTS = "part int, data binary, n long, home_pre double, away_pre double, move double"


@dataclass(frozen=True)
class Rules:
    k: float
    home: float
    initial: float
    regress: float
    mean: float
    tolerance: float
    parts: int

    def drawn(self, seasons: np.ndarray) -> np.ndarray:
        return (1.0 - self.regress) ** seasons.astype(np.float64)

    def move(self, gap: np.ndarray, won: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """What the home side gains: by the result against its expectation, the margin, and less for favourites that win."""
        expected = 1 / (1 + np.exp(gap * (-np.log(10.0) / 400)))
        damp = 2.2 / (np.where(won == 1, np.maximum(gap, 0.0), 0.0) * 0.001 + 2.2)
        return weight * damp * (won - expected)


def packed(rows: pa.Table) -> pa.Table:
    """A part's games of a block as arrays, by team in the games' order; teams of as many games lie together."""
    a, b, n, partner, home = (rows.column(c).to_numpy() for c in ("a", "b", "n", "partner", "home"))
    order = np.lexsort((n, b, a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    size = np.diff(np.append(first, len(a)))
    by_size = np.argsort(size, kind="stable")
    first, size = first[by_size], size[by_size]
    order = order[np.repeat(first - (np.cumsum(size) - size), size) + np.arange(len(order))]
    teams = np.stack((a[first], b[first]), 1).astype(">i8").view("S16").ravel()
    n, partner, home = n[order], partner[order], home[order]
    route = np.lexsort((home, n, partner)).astype(np.int32)
    static = {"teams": teams, "size": size, "n": n, "home": home, "route": route, "s": rows.column("_s").to_numpy()[order], "margin": rows.column("margin").to_numpy()[order], "to": partner[route]}
    static["to"] = np.unique(static["to"], return_counts=True)
    return pa.table([rows.column("block")[:1], rows.column("part")[:1], pa.array([pickle.dumps(static)], pa.binary())], names=["block", "part", "data"])


def _read(batches: Iterator[pa.RecordBatch]) -> dict[int, dict]:
    """Of each part its static, ratings and state, and its mail as (source, values)."""
    out: dict[int, dict] = defaultdict(lambda: {"mail": []})
    for batch in batches:
        for part, kind, source, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if kind == "mail":
                out[part]["mail"].append((source, np.frombuffer(data, np.float64)))
            else:
                out[part][kind] = pickle.loads(data)
    return out


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, kinds[t]) for v, (_, t) in zip(zip(*rows), fields)], names=[f for f, _ in fields])


def _told(part: int, state: dict) -> list[tuple[int, np.ndarray]]:
    """What each part with games against this one is told; a game within the part swaps its two ratings."""
    parts, counts = state["to"]
    ends = np.cumsum(counts)
    out = []
    for q, lo, hi in zip(parts.tolist(), (ends - counts).tolist(), ends.tolist()):
        values = state["pre"][state["route"][lo:hi]]
        out.append((q, values.reshape(-1, 2)[:, ::-1].ravel() if q == part else values))
    return out


def _heard(state: dict, mail: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """The rivals' ratings before each game."""
    parts, counts = state["to"]
    begin = dict(zip(parts.tolist(), (np.cumsum(counts) - counts).tolist()))
    other = np.empty(len(state["pre"]))
    for q, values in mail:
        other[state["route"][begin[q] : begin[q] + len(values)]] = values
    return other


def _gains(state: dict, other: np.ndarray, rules: Rules) -> np.ndarray:
    home, pre = state["home"], state["pre"]
    sign = home * 2.0 - 1
    return rules.move((pre - other) * sign + rules.home, state["won"], state["weight"]) * sign


def _running(state: dict, gains: np.ndarray, rules: Rules) -> np.ndarray:
    """Ratings before each game: the first one and all gains since, drawn to the mean by the seasons between."""
    s = state["s"]
    seasons = np.arange(int(s.max(initial=0)) + 1)
    weighed, earlier, at = gains * rules.drawn(-seasons)[s], np.zeros(len(gains)), 0
    for size, teams in zip(*state["runs"]):
        if size > 1:
            earlier[at : at + size * teams].reshape(teams, size)[:, 1:] = weighed[at : at + size * teams].reshape(teams, size)[:, :-1].cumsum(axis=1)
        at += size * teams
    return state["base"] + rules.drawn(seasons)[s] * earlier


def _out(part: int, state: dict, most: float) -> pa.RecordBatch:
    return _rows(ROWS, [(part, "state", None, pickle.dumps(state), most), *((q, "mail", part, v.tobytes(), None) for q, v in _told(part, state))])


def _found(teams: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of `teams` among `known`, in order, and which of them are there."""
    at = np.minimum(np.searchsorted(known, teams), max(len(known) - 1, 0))
    return at, known[at] == teams if len(known) else np.zeros(len(teams), bool)


def begun(batches: Iterator[pa.RecordBatch], rules: Rules) -> Iterator[pa.RecordBatch]:
    """static and ratings: the state of a part as if its games moved nothing."""
    for part, have in _read(batches).items():
        if "static" not in have:
            continue
        g = have["static"]
        known, rating, last = have.get("ratings", (np.zeros(0, "S16"), np.zeros(0), np.zeros(0, np.int32)))
        first = g["s"][np.cumsum(g["size"]) - g["size"]]
        at, there = _found(g["teams"], known)
        old, since = np.full(len(there), rules.initial), first.copy()
        old[there], since[there] = rating[at[there]], last[at[there]]
        base = rules.mean + (np.repeat(old, g["size"]) - rules.mean) * rules.drawn(g["s"] - np.repeat(since, g["size"]))
        size, teams = np.unique(g["size"], return_counts=True)
        state = {"runs": (size.tolist(), teams.tolist()), "base": base, "pre": base, "s": g["s"] - g["s"].min()} | {c: g[c] for c in ("home", "route", "to")}
        state |= {"won": np.where(g["margin"] == 0, 0.5, g["margin"] > 0).astype(np.float16), "weight": rules.k * np.log(np.abs(g["margin"]) + 1)}
        yield _out(part, state, 0.0)


def swept(batches: Iterator[pa.RecordBatch], rules: Rules) -> Iterator[pa.RecordBatch]:
    """state and mail: the state a sweep on, and the most that a rating has changed. Where all teams are in one part it goes on until they settle."""
    for part, have in _read(batches).items():
        state = have["state"]
        mail = have["mail"]
        while True:
            before, state["pre"] = state["pre"], _running(state, _gains(state, _heard(state, mail), rules), rules)
            most = float(np.abs(state["pre"] - before).max(initial=0))
            if rules.parts > 1 or most <= rules.tolerance:
                break
            mail = _told(part, state)
        yield _out(part, state, most)


def ended(batches: Iterator[pa.RecordBatch], rules: Rules) -> Iterator[pa.RecordBatch]:
    """All kinds: the ratings that a part's block leaves, and a row for each game of its home teams."""
    for part, have in _read(batches).items():
        known, rating, last = have.get("ratings", (np.zeros(0, "S16"), np.zeros(0), np.zeros(0, np.int32)))
        if "state" in have:
            g, state = have["static"], have["state"]
            other = _heard(state, have["mail"])
            gains = _gains(state, other, rules)
            ends = np.cumsum(g["size"]) - 1
            old = ~np.isin(known, g["teams"])
            known, rating, last = (np.concatenate((x[old], y)) for x, y in ((known, g["teams"]), (rating, (state["pre"] + gains)[ends]), (last, g["s"][ends])))
            order = np.argsort(known)
            known, rating, last = known[order], rating[order], last[order]
            mine = np.flatnonzero(g["home"])
            for i in range(0, len(mine), 1 << 16):
                m = mine[i : i + (1 << 16)]
                none = [pa.nulls(len(m), t) for t in (pa.int32(), pa.binary())]
                yield pa.RecordBatch.from_arrays([*none, *(pa.array(x[m]) for x in (g["n"], state["pre"], other, gains))], names=[x.split()[0] for x in RESULTS.split(", ")])
        yield _rows(RESULTS, [(part, pickle.dumps((known, rating, last)), None, None, None, None)])
