"""Plain versions of the operators' contracts, and texts with every awkward case."""

import hashlib
import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, row string"


def documents(n=120, seed=3):
    """Nulls, empty and long texts, copies, near copies, repeated rows, shared passages, unicode; doc_id and text first."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeéüß漢") for _ in range(r.randint(1, 9))) for _ in range(300)]
    words = lambda k: [r.choice(vocabulary) for _ in range(k)]
    shared = [" ".join(words(90)) for _ in range(3)]
    texts = [None, "", " \n\t ", "one", "Two words", " ".join(words(9000)), "x" * 5000]
    while len(texts) < n:
        kind = r.random()
        if kind < 0.2 and len(texts) > 10:
            texts.append(r.choice(texts))
        elif kind < 0.4 and len(texts) > 10:
            base = (r.choice(texts) or "a b").split(" ")
            base[r.randrange(len(base))] = "CHANGED"
            texts.append(" ".join(base))
        elif kind < 0.6:
            texts.append(" ".join(words(30)) + r.choice(["\n", " ", "\x0b"]) + r.choice(shared) + " " + " ".join(words(20)))
        else:
            texts.append(" ".join(words(r.randint(1, 200))))
    rows = [(i * 3 + 1, t, r.choice(["en", None]), r.choice(["hot", "hot", "a", None]), len(t or ""), "clash", "clash") for i, t in enumerate(texts)]
    return rows + rows[:2] + [rows[9]]


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def roots(n, pairs):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, size=5):
    """Of lowered words; of fewer, the whole sequence."""
    w = lowered(text).encode().split()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def words9(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered(text))
