import re
from collections import Counter

from colsieve.llm import line_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(docs, most, lost):
    norm = lambda line: " ".join(w.encode().lower().decode() for w in WORD.findall(line))
    lines = [[x for x in (t or "").split("\n") if WORD.search(x)] for _, t, _ in docs]
    held = Counter((s, x) for (_, _, s), ls in zip(docs, lines, strict=True) for x in {norm(y) for y in ls})
    out = []
    for (doc_id, text, source), ls in zip(docs, lines, strict=True):
        text = text or ""
        w = WORD.findall(text)
        grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        covered = {i + k for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for k in range(5)}
        removed = sum(len(WORD.findall(x)) for x in ls if held[source, norm(x)] > most)
        failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
        out.append((doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(ls) - len(set(ls)),
                    len(covered), removed, failed, not failed and removed <= lost * len(w)))
    return sorted(out, key=repr)


def test_equals_brute_force(spark, small):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    docs += [(1000 + k, f"This line  is in many\nalone {k} " + " ".join(f"q{k}x{j}" for j in range(12)), "s") for k in range(9)]
    docs += [(2000 + k, "this LINE is in many \n\n a b c d e f g h\tthis line is in many\nthis LINE is in many ", None) for k in range(5)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = line_rules.quality_rules(frame, max_documents=4)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_force(docs, 4, line_rules.MAX_LOST)


def test_common_lines_are_taken_out(spark):
    docs = [(k, f"Read  MORE\nown {k}\n\nread more", "s" if k < 6 else None) for k in range(8)] + [(9, None, "s")]
    out = {r.doc_id: r.text for r in line_rules.without_common_lines(
        spark.createDataFrame(docs, "doc_id long, text string, source string"), max_documents=4).collect()}
    assert out[0] == "own 0\n" and out[7] == "Read  MORE\nown 7\n\nread more" and out[9] == ""


def test_awkward_rows(spark, awkward, clashing, no_docs):
    docs = [(r.doc_id, r.text, r.source) for r in awkward.collect()]
    want = brute_force(docs, line_rules.MAX_DOCUMENTS, line_rules.MAX_LOST)
    for frame in (awkward, clashing):
        assert sorted(map(tuple, line_rules.quality_rules(frame).collect()), key=repr) == want
    assert line_rules.quality_rules(no_docs).count() == 0


def test_removed_words_are_those_that_left_the_text(spark, monkeypatch):
    """The verdict rests on lines that are taken out, in passes of a few common lines each."""
    monkeypatch.setattr(line_rules, "PIECE_LINES", 2)
    docs = [(k, f"Top  bar\nown {k} " + " ".join(f"t{k}x{j}" for j in range(9)) + f"\n\nfoot {k % 2}\ntop BAR\nside\nend", "s") for k in range(12)]
    docs += [(20, None, "s"), (21, "", None), (22, "Top bar\nside", None), (22, "Top bar\nside", None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = line_rules.clean(frame, max_documents=5).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.n_words - r.n_removed_words == len(WORD.findall(r.text))
    texts = {r.doc_id: r.text for r in rows}
    assert texts[3].startswith("own 3 ") and texts[3].count("\n") == 1 and texts[3].endswith("x8\n")
    assert texts[20] == texts[21] == "" and texts[22] == "Top bar\nside"
    got = line_rules.quality_rules(frame, max_documents=5)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_force(docs, 5, line_rules.MAX_LOST)
