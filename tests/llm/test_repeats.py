"""Exact repeats against brute force, with nulls, repeated rows and long texts."""

import hashlib
import random

from cellwise.llm import passages, substrings


def corpus(seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared, long = text(60), text(3000)
    rows = [(i, text(rng.randrange(120))) for i in range(30)]
    rows += [(100 + i, text(20) + " \t" + shared + "\n" + text(15)) for i in range(8)]
    rows += [(200, shared), (201, shared), (202, long), (203, long + " tail"), (204, shared + " " + shared), (205, "aaaa" * 100)]
    rows += [(300, None), (301, ""), (302, " \n "), (303, "é" * 60), (304, "é" * 60), (None, shared), (None, text(30))]
    return rows


def brute_words(rows):
    seen, out = {}, {}
    for key, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        words = (text or "").replace("\t", " ").replace("\n", " ").split(" ")
        words = [w for w in words if w]
        cover = [False] * len(words)
        for p in range(len(words) - 19):
            window = tuple(words[p : p + 20])
            if window in seen and seen[window] != (key, None):
                cover[p : p + 20] = [True] * 20
            seen.setdefault(window, True)
        out.setdefault(key, []).append((len(words), sum(cover), " ".join(w for w, c in zip(words, cover, strict=True) if not c)))
    return out


def test_words_match_brute_force(docs):
    rows = corpus()
    known = [r for r in rows if r[0] is not None]
    found = passages.remove_repeats(docs(rows)).collect()
    assert len(found) == len(rows)
    wanted = brute_words(known)
    for row in found:
        if row["doc_id"] is not None:
            assert (row["n_words"], row["n_removed"], row["kept"]) == wanted[row["doc_id"]][0], row["doc_id"]
    assert [r["n_removed"] for r in found if r["doc_id"] is None and r["n_words"] == 60] == [60]


def test_bytes_match_brute_force(docs):
    rows = [r for r in corpus(2) if r[0] is not None]
    found = {r["doc_id"]: r for r in substrings.remove_repeats(docs(rows)).collect()}
    seen = {}
    for key, text in sorted(rows):
        raw = (text or "").encode()
        cover = [False] * len(raw)
        for p in range(len(raw) - 49):
            if seen.setdefault(raw[p : p + 50], key) < key:
                cover[p : p + 50] = [True] * 50
        kept = bytes(b for b, c in zip(raw, cover, strict=True) if not c)
        spans = sum(c and not (p and cover[p - 1]) for p, c in enumerate(cover))
        row = found[key]
        assert (row["n_bytes"], row["n_removed"], row["n_spans"]) == (len(raw), sum(cover), spans), key
        assert hashlib.sha256(bytes(row["kept"])).digest() == hashlib.sha256(kept).digest()


def test_rows_that_share_an_id_do_not_remove_from_one_another(docs):
    text = " ".join(f"w{i}" for i in range(40))
    found = passages.remove_repeats(docs([(1, text), (1, text), (1, text + " more")])).collect()
    assert [r["n_removed"] for r in found] == [0, 0, 0]


def test_empty_table(docs):
    assert passages.remove_repeats(docs([])).count() == 0
    assert substrings.remove_repeats(docs([])).count() == 0
