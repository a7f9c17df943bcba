import hashlib
import random
from collections import defaultdict

import pyarrow as pa
from helpers import clashing, collected, documents

from stratalake.llm import linededup

BLANKS = " \t\n\x0b\x0c\r"


def plain(rows, min_chars=40, min_docs=5):
    holders = defaultdict(set)
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [s for s in lines if len(holders.get(key(s), ())) < min_docs or doc == max(holders[key(s)], key=lambda d: -1 if d is None else d)]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def fixture():
    rng = random.Random(8)
    common = [f"Common line {i} " + "xÉ" * rng.randrange(10, 30) for i in range(12)]
    hot = "THE line that every document holds, again and again"
    rows = [(None, hot), (None, f"{hot}\nno id"), (0, None), (1, ""), (2, "\n\n"), (3, "short\n" * 3)]
    for doc in range(10, 90):
        lines = [rng.choice(common) for _ in range(rng.randrange(6))] + [f"own line of document {doc} " + "y" * 40]
        lines += [hot.upper() if doc % 2 else f" \t{hot.lower()}\r"] * rng.randrange(1, 4)
        rng.shuffle(lines)
        rows.append((doc, "\n".join(lines)))
    four = "a line that only four documents hold, and so it stays"
    rows += [(200 + i, four) for i in range(4)] + rows[-3:]
    return rows


def test_matches_plain_form(spark):
    rows = fixture()
    docs = clashing(documents(spark, [t for _, t in rows], [d for d, _ in rows]))
    want = sorted(((d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in plain(rows)), key=str)
    for partitions in ("1", "7"):  # one range, and a key over many ranges
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert sorted(map(tuple, linededup.dropped_digests(docs).collect()), key=str) == want
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    kept = linededup.drop_lines(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=str) == sorted(((d, t) for d, _, _, t in plain(rows)), key=str)
    assert kept.where("text is not null and n_chars <> length(text)").count() == 0
    assert {r.bitmap for r in kept.select("bitmap").collect()} == {"mine"}


def test_runs_over_task_borders():
    """Sorted rows cut at every place give the same decisions."""
    rows = [(1, 1, d, 0, p) for d in (9, 8, 8, 7, 6, 5, 4) for p in (0, 1)] + [(1, 2, d, 0, 0) for d in (9, 8, 7, 6)]
    types = [pa.int64()] * 4 + [pa.int32()]
    names = ["h1", "h2", "doc_id", "text_hash", "pos"]
    batch = lambda part: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), types)], names=names)
    for cut in range(0, len(rows) + 1, 2):
        marks = [m for part in (rows[:cut], rows[cut:]) if part for b in linededup.stream_marks(iter([batch(part)]), 5) for m in b.to_pylist()]
        seen = defaultdict(lambda: [0, -1])
        for m in marks:
            if m["kind"] == 2:
                seen[m["h1"], m["h2"]][0] += m["n_docs"]
                seen[m["h1"], m["h2"]][1] = max(seen[m["h1"], m["h2"]][1], m["doc_id"])
        gone = set()
        for m in marks:
            docs, keeper = seen[m["h1"], m["h2"]]
            if m["kind"] == 0 or m["kind"] == 1 and docs >= 5 and m["doc_id"] != keeper:
                gone.add((m["h2"], m["doc_id"], m["pos"]))
        if rows[cut - 1][2] != rows[min(cut, len(rows) - 1)][2] or cut in (0, len(rows)):  # ranges never part one document's rows
            assert gone == {(1, d, p) for d in (8, 7, 6, 5, 4) for p in (0, 1)}


def test_bitmaps():
    for dropped in ([0], [3], [0, 7, 8], [20]):
        text = "\n".join(map(str, range(25)))
        kept, lines, gone = linededup.kept_lines(text, linededup.pack_bitmap(dropped))
        assert (lines, gone) == (25, len(dropped)) and kept.split("\n") == [str(i) for i in range(25) if i not in dropped]


def test_empty_table(spark):
    assert linededup.dropped_digests(documents(spark, [])).collect() == []
    assert collected(linededup.drop_lines(documents(spark, []))) == []
