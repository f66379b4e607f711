"""Small documents with every awkward case, and plain-Python versions of what operators must return."""

import hashlib
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, row string, shard int, start int, n_chars long, mask string"
"""Documents with extra columns whose names operators use themselves."""


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghiéß") for _ in range(rng.randint(2, 7))) for _ in range(n))


def sample():
    shared = prose(1, 30)
    base = prose(2, 150)
    edited = base.split(" ")
    edited[40] = "changed"
    texts = [
        None,
        "",
        "   \n\t ",
        "one",
        "tie tie tie tie",
        prose(3, 60) + "\n" + shared + "\nA line that many documents share here",
        "  a LINE that many documents share here \n" + prose(4, 80) + " " + shared,
        base,
        base,
        " ".join(edited),
        "A line that many documents share here\nA line that many documents share here\nshort\n",
        prose(5, 8000) + " " + shared + " " + shared,
        shared + "\n" + "x\x85y z w v 𝒳 " * 30,
        "mail a.b@c.example.com or +49 (30) 1234-5678, 10.0.0.255 and 4111 1111 1111 1111 " + prose(6, 30),
        "trailing space " + prose(7, 25) + " ",
    ]
    rows = [(i, t, f"r{i}", i, i, None if t is None else len(t), "m") for i, t in enumerate(texts)]
    rows.append((None, prose(8, 60) + " " + shared, None, None, None, None, None))
    rows.append(rows[9])  # a row that occurs twice
    return rows


def frame(spark, rows=None):
    rows = sample() if rows is None else rows
    return spark.createDataFrame(rows, SCHEMA).repartition(3) if rows else spark.createDataFrame([], SCHEMA)


def linked(n_copies=40):
    """Near copies of one text that differ by one word each, and exact ones."""
    base = prose(20, 120).split(" ")
    out = []
    for i in range(n_copies):
        words = list(base)
        if i % 3:
            words[(i * 7) % 120] = f"edit{i}"
        out.append((i, " ".join(words)))
    return out
