import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_data import documents, odd_texts, prose

from candlemill.llm import line_rules as R
from candlemill.llm.common import text_buffer


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base(text):
    words = words_of(text)
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    n = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(8)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(hit),
    )


def normal(line):
    line = re.sub("[A-Z]", lambda m: m[0].lower(), line)
    return " ".join(words_of(re.sub("[0-9]", "0", line)))


def brute(rows, percent=10, least=10, kept_percent=30):
    texts = defaultdict(set)
    for _, text, host in rows:
        texts[host].add(text or "")
    common = set()
    for host, own in texts.items():
        n = Counter(x for t in own for x in {normal(y) for y in t.split("\n")} if x)
        common |= {(host, x) for x, k in n.items() if k >= least and 100 * k > percent * len(own)}
    out = []
    for i, text, host in rows:
        found = base(text)
        n, again = found[0], found[4]
        gone = [x for x in map(normal, (text or "").split("\n")) if (host, x) in common]
        lost = sum(len(x.split(" ")) for x in gone)
        failed = n < 20 or 100 * again > 30 * n
        kept = not failed and n - lost >= 20 and 100 * (n - lost) >= kept_percent * n
        out.append((i, *found, failed, len(set(gone)), lost, kept))
    return sorted(out, key=repr)


def some_rows():
    rng = random.Random(4)
    rows = []
    for i in range(240):
        lines = [prose(rng, rng.randint(3, 12)) + rng.choice(["", " #1", " <b>"]) for _ in range(rng.randint(0, 5))]
        if i % 3 == 0:
            lines.insert(rng.randint(0, len(lines)), rng.choice(["Menu  home page 7", "menu HOME\tpage 8"]) + " x" * 9)
        if i % 5 == 0:
            lines += lines[:1] * 2
        rows.append((i, "\n".join(lines), f"h{i % 4}" if i % 4 else None))
    rows += [(1000 + i, "only copies of this line here " * 6, "h1") for i in range(90)]
    rows += [(7, None, "h1"), (7, "other text", None), (None, "x " * 40, "h2")]
    return rows + [(2000 + i, t, "h3") for i, t in enumerate(odd_texts())]


def test_equals_brute_force(spark):
    rows = some_rows()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, n_words int")
    wanted = brute(rows)
    assert any(r[-2] and r[-1] for r in wanted) and any(r[-2] and not r[-1] and not r[6] for r in wanted)
    assert sorted((tuple(r) for r in R.judge(df).collect()), key=repr) == wanted


def test_empty_table(spark):
    assert R.judge(documents(spark, []).limit(0)).count() == 0


def test_clean_texts(spark):
    rows = some_rows()
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, source string, _gone string")
    common = R.common_lines(R.measure(df, "doc_id", "source", "text"))
    left = {
        (r["doc_id"], r["text"]): r["clean"]
        for r in R.without_common_lines(df, common, ["doc_id", "text", "source"]).collect()
    }
    lines = {(r["host"], r["line"]) for r in common.collect()}
    assert len(lines) >= 3
    assert len(left) == len({(i, t) for i, t, _ in rows})
    for i, text, host in rows:
        clean = left[i, text]
        if text is None:
            assert clean is None
            continue
        found = R.Measured(*text_buffer(pa.array([text])))
        gone = Counter()
        for key, a, b in zip(found.line_keys, *found.line_spans):
            if (host, key) in lines:
                gone[text.encode()[a:b].decode()] += 1
        wanted = Counter(text.split("\n")) - gone
        assert Counter(clean.split("\n")) == (wanted or Counter([""]))


@pytest.mark.parametrize("text", ["", "\n", "a", "a\n", "\na\n\nb", "a\r\na"])
def test_lines_of_one_text(text):
    data, offsets = text_buffer(pa.array(["x\ny", text, None, text, "z"]))
    starts, ends, rows = R._line_spans(data, offsets)
    raw = data.tobytes()
    got = [raw[a:b].decode() for a, b, r in zip(starts, ends, rows) if r == 3]
    assert got == text.split("\n") and np.bincount(rows, minlength=5)[2] == 1
