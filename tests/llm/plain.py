"""Plain versions of operators, written with dictionaries and loops."""

import hashlib
import math
import re
from collections import Counter, defaultdict


def kneser_ney(texts, order):
    """Interpolated modified Kneser-Ney over UTF-16 units: a function (history, unit) ->
    probability, from whole texts."""
    def units(t):
        raw = t.encode("utf-16-le", "surrogatepass")
        return [raw[i] + 256 * raw[i + 1] for i in range(0, len(raw), 2)]

    counts = {order: Counter()}
    for t in texts:
        u = [0] * (order - 1) + units(t)
        counts[order].update(tuple(u[i - order + 1 : i + 1]) for i in range(order - 1, len(u)))
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])  # one for each distinct left extension

    def discount(n):
        of = Counter(counts[n].values())
        y = of[1] / (of[1] + 2 * of[2]) if of[1] else 0.5
        return [0.0] + [min(float(i), max(0.0, i - (i + 1) * y * of[i + 1] / of[i])) if of[i] else 0.5 * i for i in (1, 2, 3)]

    cut = {n: discount(n) for n in counts}
    total, left = {n: Counter() for n in counts}, {n: Counter() for n in counts}
    for n, table in counts.items():
        for g, c in table.items():
            total[n][g[:-1]] += c
            left[n][g[:-1]] += cut[n][min(c, 3)]
    kinds = len(counts[1])

    def probability(gram):
        n = len(gram)
        if not n:
            return 1 / (kinds + 1)
        h = gram[:-1]
        lower = probability(gram[1:])
        if not total[n][h]:
            return lower
        c = counts[n][gram]
        return (max(c - cut[n][min(c, 3)], 0) + left[n][h] * lower) / total[n][h]

    def surprise(t):
        u = [0] * (order - 1) + units(t)
        return [-math.log(probability(tuple(u[i - order + 1 : i + 1]))) for i in range(order - 1, len(u))]

    return surprise


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near_groups(rows):
    """{id: (set size, component)} by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1 :]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def topic(text):
    text = text or ""
    for name, marks in (("license", ["Licensed under"]), ("table", [" | "]), ("shout", ["!!"]), ("symbols", ["***", "%%%"])):
        if any(m in text for m in marks):
            return name
    return "prose"


def mix(docs, rate, seed, powers, wanted, sweeps):
    """{id: (factor, p, sampled)} of docs (id, text, source, lang)."""
    cell = {i: (f"{s}", f"{lang}", topic(t)) for i, t, s, lang in docs}
    tokens = {i: len(words(t)) for i, t, _, _ in docs}
    base = defaultdict(float)
    for i in cell:
        base[cell[i]] += tokens[i]
    mass = sum(base.values())
    goals = []
    for k, name in enumerate(("source", "lang", "topic")):
        sums = defaultdict(float)
        for c, w in base.items():
            sums[c[k]] += w
        table = wanted.get(name)
        raw = {v: (table.get(v, min(table.values())) if table else w ** powers.get(name, 1.0)) for v, w in sums.items() if w > 0}
        goals.append({v: g / sum(raw.values()) * mass for v, g in raw.items()})
    weight = dict(base)
    for _ in range(sweeps):
        for k in range(3):
            had = defaultdict(float)
            for c, w in weight.items():
                had[c[k]] += w
            weight = {c: w * goals[k][c[k]] / had[c[k]] if c[k] in goals[k] else w for c, w in weight.items()}
    out = {}
    for i in cell:
        f = weight[cell[i]] / base[cell[i]] if base[cell[i]] else 1.0
        u = int(hashlib.md5(f"={i}#{seed}".encode()).hexdigest()[:12], 16) / 2**48
        out[i] = (f, min(1.0, rate * f), u < min(1.0, rate * f))
    return out


def bounded_mix(docs, rate, seed, powers, wanted, max_repeats, tolerance, sweeps, stalled=0.9):
    """{id: copies} and {(margin, value): (goal, reachable, raked)} of docs (id, text, source,
    lang), by bounded raking."""
    cell = {i: (f"{s}", f"{lang}", topic(t)) for i, t, s, lang in docs}
    base = defaultdict(float)
    for i, t, _, _ in docs:
        base[cell[i]] += len(words(t))
    base = {c: w for c, w in base.items() if w > 0}
    mass, cap = sum(base.values()), {c: w * max_repeats / rate for c, w in base.items()}
    goals, reach = [], []
    for k, name in enumerate(("source", "lang", "topic")):
        sums, supply = defaultdict(float), defaultdict(float)
        for c, w in base.items():
            sums[c[k]] += w
            supply[c[k]] += cap[c]
        table = wanted.get(name)
        raw = {v: (table.get(v, min(table.values())) if table else w ** powers.get(name, 1.0)) for v, w in sums.items()}
        goals.append({v: g / sum(raw.values()) * mass for v, g in raw.items()})
        full = set()
        while True:  # values that can't have their part are given all they have
            rest = sum(g for v, g in goals[k].items() if v not in full)
            level = (mass - sum(supply[v] for v in full)) / rest if rest else 0
            more = {v for v, g in goals[k].items() if v not in full and g * level > supply[v]}
            if not more:
                break
            full |= more
        reach.append({v: supply[v] if v in full else g * level for v, g in goals[k].items()})
    weight, last = {c: min(w, cap[c]) for c, w in base.items()}, math.inf
    for _ in range(sweeps):
        error = 0
        for k in range(3):
            had = defaultdict(float)
            for c, w in weight.items():
                had[c[k]] += w
            error = max([error, *(abs(had[v] - r) for v, r in reach[k].items())])
            weight = {c: min(cap[c], w * reach[k][c[k]] / had[c[k]]) for c, w in weight.items()}
        if error <= tolerance * mass or error > stalled * last:
            break
        last = error
    out = {}
    for i in cell:
        wish = min(max_repeats, rate * weight[cell[i]] / base[cell[i]] if cell[i] in base else rate)
        u = int(hashlib.md5(f"={i}#{seed}".encode()).hexdigest()[:12], 16) / 2**48
        out[i] = int(wish) + (u < wish - int(wish))
    report = {}
    for k, name in enumerate(("source", "lang", "topic")):
        for v in goals[k]:
            report[name, v] = tuple(x / mass for x in (goals[k][v], reach[k][v], sum(w for c, w in weight.items() if c[k] == v)))
    return out, report
