import random
import re
from collections import Counter

from clientele.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 8)}
    lines = [s for s in (text or "").split("\n") if WORD.search(s)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


def test_base_figures(documents):
    rng = random.Random(3)
    texts = [None, "", " \n\t", "a b c", "\n".join(["same line."] * 5), "x " * 40]
    for _ in range(60):
        n = rng.choice([5, 30, 200])
        texts.append("".join(rng.choice(["a", "b", "c d", "e#", "|"]) + rng.choice([" ", "\n", "\t", " "]) for _ in range(n)))
    out = quality.clean_lines(documents(list(enumerate(texts)))).collect()
    for r in out:
        n_words, chars, symbols, dup, repeated = brute(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            n_words, chars, symbols, dup, repeated)
        assert r["base_failed"] == (n_words < 20 or 100 * repeated > 30 * n_words)
        assert not (r["kept"] and r["base_failed"])


def test_lines_and_verdict(documents):
    lines = ["Some words of a plain line that ends as lines do.", "Another one says something else, and asks why?",
             "A third has news of its own to tell!", "What comes last is short."]
    good = "\n".join(lines)
    menu = "\n".join(["Home | About | News | Contact", "Click here now.", "short title", "wow wow wow wow wow."])
    rows = quality.clean_lines(documents([(1, good), (2, menu + "\n" + good), (3, menu + "\n" + lines[3])])).collect()
    out = {r["doc_id"]: r for r in rows}
    assert out[1]["kept"] and out[1]["cleaned"] == good and out[1]["failed"] == []
    assert out[2]["kept"] and out[2]["cleaned"] == good
    assert out[2]["failed"] == ["navigation", "boilerplate", "punctuation", "boilerplate"]
    assert not out[3]["kept"]


def test_odd_documents(odd_documents):
    out = quality.clean_lines(odd_documents).collect()
    assert len(out) == odd_documents.count()
    assert all(r["base_failed"] and not r["kept"] for r in out if r["n_words"] == 0)


def test_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    out = quality.clean_lines(spark.read.parquet(f"{sf}/documents.parquet"))
    judged = out.where("not base_failed").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("kept", "quality").collect()
    clean = [r["kept"] for r in judged if r["quality"] == 1]
    junk = [r["kept"] for r in judged if r["quality"] == 0]
    assert sum(clean) >= 0.99 * len(clean) and sum(junk) <= 0.1 * len(junk)
