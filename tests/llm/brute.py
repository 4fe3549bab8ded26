"""Plain versions of the operators over lists of rows, written from their contracts."""

from __future__ import annotations

import hashlib
import math
import re
import struct
import zlib
from collections import Counter
from itertools import combinations

import xxhash

KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind: str, found: str) -> bool:
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(x) <= 255 for x in found.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    return [
        (kind, m.start(), m.end())
        for kind in KINDS
        for m in re.finditer(PATTERNS[kind], text or "")
        if valid(kind, m.group())
    ]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def word_list(text: str | None, lower: bool = False) -> list[str]:
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text)
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def shingles(text: str | None, k: int = 5, lower: bool = True) -> set[tuple[str, ...]]:
    w = word_list(text, lower)
    if not w:
        return set()
    if len(w) < k:
        return {tuple(w)}
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def components(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """{doc_id: (n_shingles, component_id)} by comparing all pairs that share a shingle."""
    sets = {d: shingles(t) for d, t in rows}
    holders: dict = {}
    for d, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(d)
    shared = Counter()
    for docs in holders.values():
        shared.update(combinations(sorted(docs), 2))
    up = {d: d for d in sets}

    def root(x: int) -> int:
        while up[x] != x:
            x = up[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def base_quality(text: str | None) -> tuple[int, int, int, int, int, bool]:
    w = word_list(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = set()
    for i in range(len(w) - 4):
        if windows[tuple(w[i : i + 5])] > 1:
            hit.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if word_list(x)]
    return (
        len(w),
        sum(map(len, w)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(hit),
        len(w) < 10 or 100 * len(hit) > 20 * len(w),
    )


def edited(rows: list[tuple[int, str | None]]) -> dict[int, str]:
    order = sorted(rows, reverse=True)
    out = {}
    for i, (d, t) in enumerate(order):
        t, after = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        out[d] = t[: len(t) - half] + after[:half]
    return out


def crc_ids(ids: list[int]) -> int:
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def repeats(rows: list[tuple[int, str | None]], least: int) -> set[tuple[int, int]]:
    """(doc, word number) of all words in passages of `least` words that another document has."""
    holders: dict = {}
    lists = {d: word_list(t) for d, t in rows}
    for d, w in lists.items():
        for i in range(len(w) - least + 1):
            holders.setdefault(tuple(w[i : i + least]), set()).add(d)
    out = set()
    for d, w in lists.items():
        for i in range(len(w) - least + 1):
            if len(holders[tuple(w[i : i + least])]) > 1:
                out.update((d, j) for j in range(i, i + least))
    return out


def stretches(rows: list[tuple[int, str | None]], least: int) -> list[tuple[int, int, int]]:
    """(doc, start, stop) of the longest stretches whose windows of `least` words another document has."""
    lists = {d: word_list(t) for d, t in rows}
    holders: dict = {}
    for d, w in lists.items():
        for i in range(len(w) - least + 1):
            holders.setdefault(tuple(w[i : i + least]), set()).add(d)
    out = []
    for d, w in lists.items():
        open_at = None
        for i in range(max(len(w) - least + 1, 0) + 1):
            here = i + least <= len(w) and len(holders[tuple(w[i : i + least])]) > 1
            if here and open_at is None:
                open_at = i
            elif not here and open_at is not None:
                out.append((d, open_at, i - 1 + least))
                open_at = None
    return sorted(out)


def rule(host: str, path: str, rules: list[tuple[str, str, str]]) -> tuple[str | None, str | None]:
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return (best[0] + best[1], best[2]) if best else (None, None)


def host_path(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def _strength(members: list[tuple[int, int]], most: float) -> float:
    n, bad = sum(m[0] for m in members), sum(m[1] for m in members)
    if not n:
        return most
    mean = bad / n
    chance = mean * (1 - mean)
    room = n - sum(m[0] ** 2 for m in members) / n
    spread = sum(m[0] * (m[1] / m[0] - mean) ** 2 for m in members)
    between = (spread - (len(members) - 1) * chance) / room if room > 0 else 0.0
    return most if between <= 0 else round(min(max(chance / between - 1, 1.0), most), 3)


def beta_below(a: float, b: float, x: float) -> float:
    """The regularised incomplete beta function, by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_below(b, a, 1 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    tiny = 1e-300
    c, d = 1.0, 1 / ((1 - (a + b) * x / (a + 1)) or tiny)
    total = d
    for m in range(1, 2000):
        for top in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 / ((1 + top * d) or tiny)
            c = (1 + top / c) or tiny
            total *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return front * total / a


def beta_quantile(a: float, b: float, p: float) -> float:
    if a <= 0 or b <= 0:
        return float(a > 0)
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if beta_below(a, b, mid) < p else (low, mid)
    return low


def host_bounds(
    rows: list[tuple[str, int | None]], tail: float, long_suffixes: list[str], most: float
) -> dict[str, tuple[int, int, float]]:
    """{host: (n, bad, lower bound)}; a NULL outcome only names its host."""

    def above(host: str) -> tuple[str, str]:
        if re.fullmatch(r"[0-9.]+(:[0-9]+)?", host):
            return host, ""
        labels = host.split(".")
        k = 2 if ".".join(labels[-2:]) in long_suffixes else 1
        return ".".join(labels[-k - 1 :]), ".".join(labels[-k:])

    levels: list[dict] = [{}, {}, {}]
    for host, bad in rows:
        if bad is not None:
            for level, name in zip(levels, (host, *above(host)), strict=True):
                n, b = level.get(name, (0, 0))
                level[name] = (n + 1, b + bad)
    n, b = map(sum, zip(*levels[2].values(), strict=True)) if levels[2] else (0, 0)
    whole = b / n if n else 0.0
    s_host, s_domain, s_suffix = (_strength(list(x.values()), most) for x in levels)

    def mean(counts: tuple[int, int], strength: float, prior: float) -> float:
        return (counts[1] + strength * prior) / (counts[0] + strength)

    out = {}
    for host in {h for h, _ in rows}:
        domain, suffix = above(host)
        p = mean(levels[2].get(suffix, (0, 0)), s_suffix, whole)
        p = mean(levels[1].get(domain, (0, 0)), s_domain, p)
        counts = levels[0].get(host, (0, 0))
        n, b = counts
        out[host] = (*counts, beta_quantile(b + s_host * p, n - b + s_host * (1 - p), tail))
    return out


def reputation(
    rows: list[tuple[int, str, int | None]], worth: float, tail: float, long_suffixes: list[str], most: float
) -> dict[str, tuple[int, int, float, str]]:
    """{host: (n, bad, lower bound, verdict)} with the limit from held-out halves."""
    half = lambda page: xxhash.xxh64_intdigest(struct.pack("<q", page), 42) % 2
    held: dict[int, list[int]] = {}
    for k in (0, 1):
        bounds = host_bounds([(h, b if half(p) == k else None) for p, h, b in rows], tail, long_suffixes, most)
        for page, host, bad in rows:
            if bad is not None and half(page) != k:
                held.setdefault(math.floor(bounds[host][2] * 100), []).append(bad)
    gains = {200: 0.0}
    for limit in held:
        above = [bad for step, listed in held.items() if step >= limit for bad in listed]
        gains[limit] = sum(above) - worth * len(above)
    limit = max(gains, key=lambda x: (gains[x], x))
    whole = host_bounds([(h, b) for _, h, b in rows], tail, long_suffixes, most)
    return {h: (*v, "block" if math.floor(v[2] * 100) >= limit else "allow") for h, v in whole.items()}
