from __future__ import annotations

import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tradewind.llm import quality

SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = SPACES.findall(text)
    lines = [x for x in text.split("\n") if SPACES.search(x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {
        i + j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(5)
    }
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


TEXTS = [
    None,
    "",
    " \t\r\x0b\x0c\n",
    "one",
    "a b c d e a b c d e f",
    "a a a a a a a",
    "x\nx\n\n \n x\nx y z #*$ %&|<>",
    "é è \U0001f600 ß\x1cword\x85next",
    "line one\nline two\nline one\nline one",
    "w " * 20_000,
]


def test_counts_equal_brute_force(spark, documents):
    draw = random.Random(3)
    texts = TEXTS + [
        "".join(draw.choice("ab c\n#é") for _ in range(draw.randrange(300))) for _ in range(60)
    ]
    folder = documents(texts, labels=("doc_id long, quality int, toxic int", [(1, 1, 0)]))
    rows = quality.op7_quality_rules(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r["doc_id"]])
        got = tuple(
            r[c] for c in "n_words word_chars n_symbols n_dup_lines n_repeat_words".split()
        )
        assert got == want, texts[r["doc_id"]]
        failed = want[0] < 10 or 100 * want[4] > 20 * want[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_cutoffs_are_learnt_per_stratum_and_spare_good_documents(spark, documents):
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    docs, labels = [], []
    for i in range(4000):
        lang, bad = ("en", "de")[i % 2], i % 8 == 1
        words = [word() + ("##" if bad else "") for _ in range(40)]
        docs.append((i, " ".join(words), lang, "s", 0))
        labels.append((i, 0 if bad else 1, 0))
    labels += [(None, 1, 0), (1, None, 0), (10**6, 1, 0), (3, 1, 0)]
    folder = documents(docs, labels=("doc_id long, quality int, toxic int", labels))
    rows = quality.op7_quality_rules(spark, folder).collect()
    kept = {r["doc_id"]: r["kept"] for r in rows}
    # Bad documents are all German: there they go, and no good one does.
    assert not any(kept[i] for i in range(4000) if i % 8 == 1)
    assert all(kept[i] for i in range(4000) if i % 8 != 1)


def test_exact_bound():
    scipy_like = [sum(__import__("math").comb(30, j) * 0.1**j * 0.9 ** (30 - j) for j in range(k + 1)) for k in (0, 3, 30)]
    assert quality.binomial_below(np.array([0, 3, 30]), 30, 0.1) == pytest.approx(scipy_like)


def plain_path(good, bad):
    """Vectors of cutoffs, by walking the hulls with exact fractions."""
    size, n, n_bad = len(good[0]), sum(good[0]), sum(bad[0])
    moves = []
    for rule in range(len(good)):
        at = size - 1
        while True:
            best = None
            for c in range(at - 1, -1, -1):
                lost, caught = sum(good[rule][c + 1 : at + 1]), sum(bad[rule][c + 1 : at + 1])
                if not lost and not caught:
                    continue
                slope = Fraction(caught, lost) if lost else float("inf")
                if best is None or slope >= best[0]:
                    best = (slope, c, lost, caught)
            if best is None or not best[3] * n > best[2] * n_bad:
                break
            moves.append((-best[0], rule, -best[1]))
            at = best[1]
    cutoffs, path = [size - 1] * len(good), []
    for _, rule, c in sorted(moves):
        cutoffs[rule] = -c
        path.append(tuple(cutoffs))
    return path


def rejected(first, step):
    """Which grid steps the path has rejected after a step."""
    return first <= step


def test_path_equals_plain_walk():
    draw = np.random.default_rng(5)
    for _ in range(40):
        # Every rule sees the same documents.
        n, n_bad = int(draw.integers(1, 60)), int(draw.integers(1, 60))
        good = np.stack([np.bincount(draw.integers(0, 8, n) // 2, minlength=12) for _ in range(3)])
        bad = np.stack([np.bincount(draw.integers(0, 12, n_bad), minlength=12) for _ in range(3)])
        path = plain_path(good.tolist(), bad.tolist())
        first = quality.path_of(good, bad)
        # Steps that no document stands on may lie on either side of a cutoff.
        there = (good + bad) > 0
        assert first[0, 0] == len(path)
        for i, cutoffs in enumerate(path):
            want = np.arange(12)[None, :] > np.array(cutoffs)[:, None]
            assert (rejected(first, i) == want)[there].all()


def test_certified_steps_are_exact_and_end_with_the_first_failure():
    p, gain = quality.certified_steps(np.array([0, 3, 10, 0, 87]), np.array([10, 5, 0, 4, 1]), 0.1)
    tail = lambda k: sum(math.comb(100, j) * 0.1**j * 0.9 ** (100 - j) for j in range(k + 1))
    assert p == pytest.approx([tail(0), tail(3), tail(13), tail(13)])
    assert gain == pytest.approx([0.5, 0.72, 0.62, 0.82])
    assert [len(x) for x in quality.certified_steps(np.array([5]), np.array([5]), 0.1)] == [0, 0]


def brute_verdicts(docs, labels, risk=0.05, error=0.05):
    """Whether each document is kept, the whole operator by hand."""
    def steps(text):
        n, chars, symbols, dup, again = brute(text)
        lines = sum(bool(SPACES.search(x)) for x in text.split("\n"))
        words, mean = max(n, 1), chars / max(n, 1)
        upper = sum("A" <= c <= "Z" for c in text)
        values = (symbols / words, dup / max(lines, 1), again / words, upper / max(chars, 1), mean / 40, max(1 - mean / 8, 0))
        return [math.ceil(min(v, 1) * quality.GRID) for v in values], n < 10 or 100 * again > 20 * n

    found = {d: (lang, *steps(text)) for d, text, lang in docs}
    taught = {d: q for d, q in labels.items() if not found[d][2]}
    laying = {d for d in taught if LAYS[d]}
    strata = sorted({found[d][0] for d in laying})
    paths, tests = {}, {}
    for s in strata:
        counts = np.zeros((2, 6, quality.GRID + 1), int)
        for d in laying:
            if found[d][0] == s:
                for rule, step in enumerate(found[d][1]):
                    counts[0 if taught[d] else 1, rule, step] += 1
        paths[s] = plain_path(*counts.tolist())
        own = [d for d in taught if d not in laying and found[d][0] == s]
        n = sum(taught[d] for d in own)
        n_bad = len(own) - n
        tests[s] = []
        for cutoffs in paths[s]:
            out = [any(x > c for x, c in zip(found[d][1], cutoffs)) for d in own]
            k = sum(o and taught[d] == 1 for o, d in zip(out, own))
            caught = sum(out) - k
            p = sum(math.comb(n, j) * risk**j * (1 - risk) ** (n - j) for j in range(k + 1)) if n else 1
            p = max(p, tests[s][-1][0] if tests[s] else 0)
            tests[s].append((p, caught / max(1, n_bad) - k / max(1, n)))
    left = len(strata)
    for worst in sorted(max((p for p, _ in tests[s]), default=0) for s in strata):
        if worst > error / left:
            break
        left = max(1, left - 1)
    chosen = {}
    for s in strata:
        good = [(g, -i) for i, (p, g) in enumerate(tests[s]) if p <= error / left and g > 0]
        if good:
            chosen[s] = paths[s][-max(good)[1]]
    return {
        d: not failed and not (s in chosen and any(x > c for x, c in zip(values, chosen[s])))
        for d, (s, values, failed) in found.items()
    }, chosen


LAYS = {}


def test_verdicts_equal_brute_force(spark, documents):
    draw = random.Random(6)
    docs, labels = [], {}
    for i in range(3000):
        lang, bad = ("en", "de", "fr")[min(2, i % 7 // 2)], draw.random() < 0.3
        size = draw.choice((3, 5, 7))
        words = ["".join(draw.choice("abcdefgh") for _ in range(size)) for _ in range(draw.randrange(8, 40))]
        for _ in range(draw.randrange(8) if bad or draw.random() < 0.05 else 0):
            words[draw.randrange(len(words))] += draw.choice(("##", "AB", "$"))
        docs.append((i, draw.choice((" ", " ", "\n")).join(words), lang, "s", 0))
        if lang != "fr" or i < 300:
            labels[i] = 0 if bad else 1
    folder = documents(docs, labels=("doc_id long, quality int, toxic int", [(d, q, 0) for d, q in labels.items()]))
    hashed = spark.range(3000).selectExpr("id", "pmod(xxhash64(id), 3) = 0 AS lays").collect()
    LAYS.update((r["id"], r["lays"]) for r in hashed)
    want, chosen = brute_verdicts([(d, text, lang) for d, text, lang, _, _ in docs], labels)
    rows = quality.op7_quality_rules(spark, folder).collect()
    assert {r["doc_id"]: r["kept"] for r in rows} == want
    assert {"en", "de"} <= set(chosen)
    assert sum(r["base_failed"] for r in rows) < sum(not x for x in want.values())


def test_empty_tables_nulls_and_repeated_rows(spark, documents):
    none = ("doc_id long, quality int, toxic int", [])
    assert quality.op7_quality_rules(spark, documents([], labels=none)).count() == 0
    rows = [(None, "a " * 12, None, None, 1), (7, "b c d " * 2, "en", "s", 1)] * 2
    found = quality.op7_quality_rules(spark, documents(rows, labels=none)).collect()
    assert [r["n_words"] for r in sorted(found, key=str)] == [6, 6, 12, 12]
