"""Lines shared by documents, against a plain model."""

import hashlib
import random

from terrace.llm import lines

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, line string, place int, h1 string, owner long, th long, places string"


def plain(rows):
    """(n_lines, n_dropped, sha256) of each row; a document is its id with its text."""
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = line.strip(SPACE).translate(LOWER)
            if len(key) >= 40:
                holders.setdefault(key, set()).add((i, t or ""))
    least = lambda i: -1 if i is None else i
    out = []
    for i, t in rows:
        each = (t or "").split("\n")
        stay = []
        for line in each:
            docs = holders.get(line.strip(SPACE).translate(LOWER), ())
            if len(docs) < 5 or least(i) == max(least(d) for d, _ in docs):
                stay.append(line)
        out.append((i, len(each), len(each) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, **more):
    docs = spark.createDataFrame([(i, t, "a", 1, "b", 2, 3, "c") for i, t in rows], SCHEMA)
    got = [tuple(r) for r in lines.without_shared_lines(docs).collect()]
    assert sorted(got, key=str) == plain(rows)
    return got


def test_lines_by_plain_model(spark):
    rng = random.Random(3)
    shared = [f"A Line {i} " + "é" * (34 - len(str(i)) + i % 3) for i in range(12)]  # 39 to 44 code points
    rows = [(0, None), (1, ""), (2, "\n\n"), (3, "no long line"), (4, "x" * 200_000 + "\n" * 3000)]
    for i in range(5, 90):
        each = []
        for _ in range(rng.randrange(12)):
            line = rng.choice(shared) if rng.random() < 0.6 else f"own line of document {i} with words {rng.random()}"
            line = rng.choice(["", " ", "\t\v", "\x1c"]) + rng.choice([line, line.upper().replace("É", "é")]) + rng.choice(["", "\r", "\f "])
            each += [line] * rng.choice([1, 1, 3])
        rows.append((i, "\n".join(each)))
    rows += [(1000 + i, shared[0]) for i in range(50)]  # only the last keeps anything
    got = check(spark, rows)
    assert sum(r[2] for r in got) > 100 and {r[3] for r in got if 1000 <= r[0] < 1049} == {hashlib.sha256(b"").hexdigest()}


def test_long_document_of_shared_lines(spark):
    text = "\n".join(f"line number {i:06d} of a text that has very many lines" for i in range(20_000))
    check(spark, [(i, f"head {i}\n{text}\ntail") for i in range(5)])


def test_no_ids_and_repeated_rows(spark):
    line = "this line is found in several documents of the table"
    check(spark, [(None, f"{line}\n{i}") for i in range(6)])  # all are the largest
    check(spark, [(7, line)] * 9)  # one document
    check(spark, [(7, f"{line}\n{i}") for i in range(3)] + [(None, line), (None, line + "\n"), (3, line), (3, line)])
    check(spark, [(3, line)] * 300 + [(i, line) for i in range(10, 14)])


def test_no_documents(spark):
    assert lines.without_shared_lines(spark.createDataFrame([], SCHEMA)).count() == 0
