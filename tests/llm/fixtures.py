"""Small tables with every awkward case, and brute-force versions of the operators."""
from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, n_words long, kept string, "
          "class_id long, score string, rejected string, row string, print string, at int, share int, rank int")
CLASH = (5, "x", 7, "s", "r", "row", "p", 3, 4, 9)          # extra columns named like the operators' own

SYLLABLES = {"en": "the and ing her ere ent tha nth was eth for dth".split(),
             "de": "der die und ein sch ich den gen ung ver".split()}


def words(rng: random.Random, n: int, lang: str = "en") -> list[str]:
    return ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n)]


def prose(rng: random.Random, n: int, lang: str = "en") -> str:
    w = words(rng, n, lang)
    return "".join(x + ("." + rng.choice([" ", "\n"]) if i % 11 == 10 else " ") for i, x in enumerate(w)).strip()


def rows(seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    out: list[tuple] = []

    def add(i, text, lang="en", source="a"):
        out.append((i, text, lang, source, None if text is None else len(text), *CLASH))

    base = prose(rng, 300)
    add(0, base)
    add(1, base)                                            # exact copy
    near = base.split(" ")
    near[40], near[160] = "changed", "otherwise"
    add(2, " ".join(near))                                  # near copy
    add(3, None)
    add(4, "")
    add(5, " \n\t \n")
    add(6, prose(rng, 2000) + " " + "a" * 20_000 + " " + prose(rng, 4000), source="b")      # long, with a long pre-token
    add(7, ("one two three four five six seven eight nine ten eleven twelve\n" * 20).strip())
    add(8, prose(rng, 80), lang=None, source=None)
    add(None, prose(rng, 90))
    twin = prose(rng, 120)
    add(9, twin)
    add(9, twin)                                            # a repeated row
    passage = prose(rng, 70)
    for i in range(10, 60):
        lang = "de" if i % 3 == 0 else "en"
        text = prose(rng, 60, lang)
        if i % 4 == 0:
            text += "\nLicensed under some public terms, version %d.0, all rights kept.\n" % (i % 7) + prose(rng, 40, lang)
        if i % 7 == 0:
            text = text + " " + passage + " " + prose(rng, 30, lang)
        add(i, text, lang, "hot" if i < 40 else f"s{i % 3}")
    add(60, "### $$$ %%% " * 40)
    add(61, "ein\x1cmal l'été — don't  stop now 12,345 \U0001f600 <|endoftext|>\r\n\r\n naïve")
    add(62, "three words only")
    add(63, "three words only")
    return out


def write(spark, folder: str, data=None) -> str:
    spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def repeats(docs: list[tuple[int, str]], length: int = 100) -> dict:
    seen: dict[bytes, tuple] = {}
    out = {}
    for i, t in sorted(set(docs), key=lambda d: d[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for j in range(len(b) - length + 1):
            w = b[j:j + length]
            if w in seen:
                gone[j:j + length] = b"\1" * length
            else:
                seen[w] = (i, j)
        kept = bytes(x for x, r in zip(b, gone) if not r)
        out[i] = (len(b), sum(gone), sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1])), sha(kept))
    return out


def counts(text: str | None) -> tuple:
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    tri = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = set()
    for i in range(len(w) - 2):
        if tri[tuple(w[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(hit)


def crc(ids) -> int:
    import numpy as np
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def shingles(text: str | None) -> Counter:
    w = WORD.findall(text or "")
    if not w:
        return Counter()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def weighted_classes(docs: list[tuple], idf) -> dict:
    """Connected components of all pairs with weighted Jaccard >= 0.8 (weights: count times idf)."""
    import itertools
    sets = {i: {s: n * idf(s) for s, n in shingles(t).items()} for i, t in docs}
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        low = sum(min(v, y[s]) for s, v in x.items() if s in y)
        high = sum(x.values()) + sum(y.values()) - low
        if x and y and low / high >= 0.8:
            parent[find(b)] = find(a) if find(a) < find(b) else find(b)
            parent[find(a)] = min(find(a), find(b))
    return {i: find(i) for i in sets}
