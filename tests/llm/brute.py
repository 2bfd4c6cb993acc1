"""Plain Python versions that the operators are held against."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

SPACE = r"[\x20\x09-\x0D]+"


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def split_words(text: str | None) -> list[str]:
    return [w for w in re.split(SPACE, text or "") if w]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def secrets(text: str | None) -> list[tuple[int, int, str, int]]:
    """Base spans as (start, rank, kind, end)."""
    text = text or ""
    found = []
    assign = r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, text):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, "assign", m.end()))
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def rules(text: str | None) -> dict:
    text = text or ""
    words = split_words(text)
    lines = [x for x in text.split("\n") if split_words(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(5)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(hit),
        "base_failed": len(words) < 10 or 100 * len(hit) > 20 * len(words),
    }


def decontaminate(text: str | None, items: list[tuple[int, str]], window: int = 10) -> dict:
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = word.findall(lower(text or ""))
    places: dict[tuple, list[int]] = {}
    for n in range(1, window + 1):
        for k in range(len(words) - n + 1):
            places.setdefault(tuple(words[k : k + n]), []).append(k)
    hit, ids = set(), set()
    for item, said in items:
        own = word.findall(lower(said))
        for i in range(max(1, len(own) - window + 1) if own else 0):
            part = tuple(own[i : i + window])
            for k in places.get(part, ()):
                hit.update(range(k, k + len(part)))
                ids.add(str(item))
    return {"n_words": len(words), "n_hit": len(hit), "n_items": len(ids), "items_sha256": sha(",".join(sorted(ids)))}


def shingles(text: str | None, size: int) -> frozenset:
    words = split_words(lower(text or ""))
    n = min(size, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else frozenset()


def components(docs: list[tuple[int, str | None]], size: int, percent: int) -> dict[int, int]:
    """doc_id -> smallest doc_id reachable; ids are unique here."""
    sets: dict[frozenset, list[int]] = {}
    for i, text in docs:
        sets.setdefault(shingles(text, size), []).append(i)
    parent = {i: i for i, _ in docs}

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def link(a: int, b: int) -> None:
        a, b = sorted((root(a), root(b)))
        parent[b] = a

    kinds = [(s, ids) for s, ids in sets.items() if s]
    for _, ids in kinds:
        for i in ids[1:]:
            link(ids[0], i)
    where: dict[tuple, list[int]] = {}
    for k, (s, _) in enumerate(kinds):
        for x in s:
            where.setdefault(x, []).append(k)
    for k, (s, ids) in enumerate(kinds):
        shared = Counter(j for x in s for j in where[x] if j > k)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(kinds[j][0]) - n):
                link(ids[0], kinds[j][1][0])
    return {i: root(i) for i, _ in docs}


def base_scores(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, int, float]]:
    """doc_id -> n_tokens, n_known, train_tokens, base_score."""
    import math
    import zlib

    end = ("",)
    tokens = {i: [*split_words(lower(t or "")), end] for i, t in docs}
    train = Counter(w for i, _ in docs if zlib.crc32(str(i).encode()) % 7 != 2 for w in tokens[i])
    n, v = sum(train.values()), len(train)
    return {
        i: (len(ws), sum(train[w] > 0 for w in ws), n, sum(math.log10((train[w] + 1) / (n + v + 1)) for w in ws))
        for i, ws in tokens.items()
    }


MASK = 2**64 - 1


def buckets(text: str | None, many: int) -> list[int]:
    """Buckets of the one- and two-word n-grams, signs being words, in integers."""
    import xxhash

    h = [xxhash.xxh3_64_intdigest(w.encode()) for w in re.findall(r"\w+|[^\w\s]+", (text or "").lower())]
    two = []
    for a, b in zip(h, h[1:], strict=False):
        x = (a * 0x9E3779B97F4A7C15 & MASK) ^ b
        two.append((x ^ (x >> 31)) * 0xBF58476D1CE4E5B9 & MASK)
    return [(x >> 40) % many for x in h + two]


def importance(docs: dict[int, str | None], quality: dict[int, list[int]], gumbel: dict[int, float], many: int, loss: float) -> dict:
    """doc_id -> log weight, key, kept."""
    import math

    raw, target = Counter(), Counter()
    good = [i for i in docs if quality.get(i) and min(quality[i]) == 1]
    for i, t in docs.items():
        raw.update(buckets(t, many))
    for i in good:
        target.update(buckets(docs[i], many))
    n_raw, n_target = raw.total() + many, target.total() + many
    ratio = [math.log((target[b] + 1) / n_target) - math.log((raw[b] + 1) / n_raw) for b in range(many)]
    weight = {i: sum(ratio[b] for b in buckets(t, many)) for i, t in docs.items()}
    least = sorted((weight[i] for i in good), reverse=True)[math.ceil(len(good) * (1 - loss)) - 1]
    k = sum(w >= least - 1e-9 for w in weight.values())
    keys = {i: weight[i] + gumbel[i] for i in docs}
    cut = sorted(keys.values(), reverse=True)[k - 1]
    return {i: (weight[i], keys[i], keys[i] >= cut) for i in docs}


def limits(lengths: list[int]) -> dict[int, tuple]:
    """length -> all columns of the report, from the definition."""
    out = {}
    for limit in set(lengths):
        within = [n for n in lengths if n <= limit]
        over = [n for n in lengths if n > limit]
        out[limit] = (
            lengths.count(limit), len(within), sum(within), len(over), sum(over), sum(min(n, limit) for n in lengths),
            len(lengths), sum(lengths), len(within) / len(lengths),
        )
    return out


def certified(rows: dict[int, tuple], good: set[int], levels: list[tuple], max_loss: float, delta: float) -> dict:
    """stratum -> number of certified levels.  rows: doc_id -> (stratum, base_failed, metrics)."""
    from fractions import Fraction
    from math import comb

    held: dict = {}
    for i, (stratum, failed, metrics) in rows.items():
        if i in good and not failed:
            held.setdefault(stratum, []).append(metrics)
    p, out = Fraction(str(max_loss)), {}
    for stratum, found in held.items():
        n, out[stratum] = len(found), 0
        for cuts in levels:
            lost = sum(any(m > c for m, c in zip(ms, cuts, strict=True)) for ms in found)
            tail = sum(comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(lost + 1))
            if float(tail) > delta / len(held):
                break
            out[stratum] += 1
    return out


def toxic_score(text: str | None, weights, bias: float, bits: int, sizes: tuple[int, ...]) -> float:
    """One n-gram after the other, in integers."""
    import math

    words, z = set((text or "").lower().split()), 0.0
    for w in words:
        points = [ord(c) for c in f" {w} "]
        for n in sizes:
            for at in range(len(points) - n + 1):
                h = n
                for k in range(n):
                    h = (h ^ points[at + k]) * 0x9E3779B97F4A7C15 & MASK
                    h ^= h >> 29
                z += float(weights[h >> (64 - bits)])
    return 1 / (1 + math.exp(-(bias + z / max(1, len(words)) ** 0.25)))


def lattice_scores(docs: list[tuple[int, str | None]], model_path: str, alpha: float) -> dict[int, float]:
    """doc_id -> log10 probability: all ways to cut each word, summed letter by letter in plain probabilities."""
    import math
    import zlib
    from functools import cache

    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=model_path)
    usable = [i for i in range(own.get_piece_size()) if not own.is_control(i) and not own.is_unknown(i)]
    train = [i for i, _ in docs if zlib.crc32(str(i).encode()) % 7 != 2]
    texts = {i: split_words(lower(t or "")) for i, t in docs}
    counts = Counter(p for i in train for w in texts[i] for p in own.encode(w))
    total = sum(counts[i] for i in usable) + len(train) + alpha * (len(usable) + 1)
    share = {own.id_to_piece(i): (counts[i] + alpha) / total for i in usable}
    byte = [share[f"<0x{b:02X}>"] for b in range(256)]
    pieces = {p: q for p, q in share.items() if not re.fullmatch(r"<0x[0-9A-F]{2}>", p)}

    longest = max(map(len, pieces))

    @cache
    def word(w: str) -> float:
        s = "\u2581" + w
        ways = [1.0] + [0.0] * len(s)
        scale = 0.0
        for end in range(1, len(s) + 1):
            for begin in range(max(0, end - longest), end):
                ways[end] += ways[begin] * pieces.get(s[begin:end], 0.0)
            ways[end] += ways[end - 1] * math.prod(byte[b] for b in s[end - 1].encode())
            if 0 < ways[end] < 1e-200:  # all shrink alike
                ways[max(0, end - longest) :] = [x * 1e200 for x in ways[max(0, end - longest) :]]
                scale -= 200
        return math.log10(ways[-1]) + scale

    end = math.log10((len(train) + alpha) / total)
    return {i: sum(map(word, ws)) + end for i, ws in texts.items()}
