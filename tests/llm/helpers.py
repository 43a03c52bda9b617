"""Documents with every awkward case, and plain-Python counterparts of the operators."""

from __future__ import annotations

import random
import re

ODD_COLUMNS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, n_tokens string, "
    "score string, component_id string, kept string, text_key string, hit_words string, good string, rid string, "
    "__good string, __quality_score string, __toxicity string, __n_words string, __hit_items string, __key string, "
    "__nth string"
)


def odd_rows() -> list[tuple]:
    long = " ".join(f"word{i % 977} and" for i in range(20_000))
    texts = [
        "the quick brown fox jumps over the lazy dog again and again today",
        "",
        None,
        "   \n\t ",
        long,
        "naïve café — 日本語 <|endoftext|> 'll don't",
        "the quick brown fox jumps over the lazy dog again and again today",
        "x" * 5000,
        "one two three",
        "\x00 odd \x1c bytes é",
    ]
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[0], rows[4], (None, "no id at all here today", None, None, None), (None, None, None, None, None)]
    return [(*r, *(["clash"] * 15)) for r in rows]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), ODD_COLUMNS)


def no_docs(spark):
    return spark.createDataFrame([], ODD_COLUMNS)


def spaced_words(text: str | None) -> list[bytes]:
    raw = re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode())
    return re.findall(rb"[^\x20\x09-\x0D]+", raw)


def alnum_words(text: str | None) -> list[bytes]:
    raw = re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode())
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", raw)


def shingle_set(text: str | None, k: int) -> frozenset:
    words = spaced_words(text)
    if not words:
        return frozenset()
    k = min(k, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def twin_words(length: int = 1024) -> tuple[str, str]:
    """Two words of one hash modulo 2**64, whatever the base: a/b by the parity of the place's ones."""
    parity = [bin(i).count("1") % 2 for i in range(length)]
    return "".join("ab"[p] for p in parity), "".join("ba"[p] for p in parity)


def prose(rng: random.Random, words: int, vocabulary: int = 3000) -> str:
    return " ".join(f"w{rng.randrange(vocabulary):x}" for _ in range(words))


def edited(rng: random.Random, text: str, share: float) -> str:
    return " ".join(f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split())


def components(sets: dict, per_cent: int = 80) -> dict:
    """Brute force: each key's least linked key."""
    names = sorted(sets)
    parent = {n: n for n in names}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            both, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if union and both and 100 * both >= per_cent * union:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {n: root(n) for n in names}
