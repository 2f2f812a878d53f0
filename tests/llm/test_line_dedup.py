import random
import re

from tideline.llm import line_dedup


def tokens(line):
    words = re.findall(r"[^\x20\x09-\x0D]+", line.lower())
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """The texts without every line that some earlier line is like."""
    earlier, out = [], []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        if text is None:
            out.append((doc_id, None, 0, 0))
            continue
        kept = []
        lines = text.split("\n")
        for line in lines:
            own = tokens(line)
            if not own or not any(100 * len(own & e) >= 80 * len(own | e) for e in earlier):
                kept.append(line)
            if own:
                earlier.append(own)
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def got(df):
    return sorted((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in line_dedup.dedup(df).collect())


def test_equals_comparison_of_all_lines(make_docs, prose, edited):
    draw = random.Random(11)
    families = [prose(f, draw.randrange(3, 90)) for f in range(25)]
    lines = families + [edited(f, i, draw.choice([1, 1, 2, 5])) for i, f in enumerate(families * 4)] + ["", "  ", "a", "A", "a b", "of the and", "Of the  and"]
    lines += [f"{prose(999, 20)} {prose(2000 + i, 6)}" for i in range(15)]
    rows = [(i, "\n".join(draw.choices(lines, k=draw.randrange(1, 9)))) for i in range(90)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, "z " * 20_000), (204, "\n".join(["same line of six words here"] * 500))]
    assert got(make_docs(rows)) == sorted(brute(rows))


def test_chain_of_similar_lines_and_large_group(make_docs, prose, edited):
    line, chain = prose(1, 60), []
    for step in range(10):
        chain.append(line)
        line = edited(line, step, 1)
    base = prose(2, 50)
    rows = [(i, t) for i, t in enumerate(chain + [edited(base, 50 + i, 1) for i in range(120)])]
    random.Random(3).shuffle(rows)
    assert got(make_docs(rows)) == sorted(brute(rows))


def test_repeated_rows_missing_ids_and_clashing_columns(spark):
    text = "one two three four five six\nalone"
    rows = [(1, text, 5, "k"), (1, text, 6, "k"), (2, text, 7, None), (None, "alone\nnew", 8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_removed int, key string")
    out = {(r["doc_id"], r["text"], r["n_removed"]) for r in line_dedup.dedup(docs).collect()}
    # A row without an id is earlier than all others, and rows that are one document lose the same lines.
    assert out == {(None, "alone\nnew", 0), (1, "one two three four five six", 1), (2, "", 2)}
    assert line_dedup.dedup(docs).count() == 4
    assert line_dedup.dedup(docs).columns == ["doc_id", "text", "key", "n_lines", "n_removed"]


def test_shingles_are_hashed_once_per_line(make_docs):
    firsts = line_dedup.first_lines(make_docs([(1, "a b c d e f\n \t\n\nword\na B c d e f")]))
    plan = firsts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("arrays_zip") == 1
    assert sorted((r["line_no"], r["n"]) for r in firsts.collect()) == [(0, 2), (3, 1)]


def test_empty_table(make_docs):
    assert got(make_docs([])) == []
