"""Small helpers of the training-data tests."""

import random


def docs_table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))


def plain_components(rows, percent=80):
    """The smallest id that links reach from each id; rows: (id, text)."""
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}
    for i in sets:
        for j in sets:
            if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = {k: new if x == old else x for k, x in root.items()}
    return root
