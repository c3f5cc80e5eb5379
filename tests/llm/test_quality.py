"""Quality rules, classifier, personal data, chat and URL operators."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from loomlog.llm import chat, classifier, pii, rules, urls
from pyspark.sql import functions as F


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def docs_frame(spark, rows):
    """Documents with columns whose names clash with those the operators make."""
    return spark.createDataFrame([(i, t, lang, 9, "r", 0.5) for i, t, lang in rows],
                                 "doc_id long, text string, lang string, n_words long, row string, score double")


def labels_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def prose(r, n):
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(n))


def base_counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    inside = {p for k in range(len(w) - 7) if seen[tuple(w[k:k + 8])] > 1 for p in range(k, k + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 20 or 100 * len(inside) > 30 * len(w)
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside), failed


def test_base_counts(spark):
    r = random.Random(1)
    phrase = "one two three four five six seven eight nine"
    texts = ["", None, "short", phrase + " " + phrase, "x " * 300, prose(r, 40) + " " + phrase + "\n" + prose(r, 60) + " " + phrase,
             "a\u00a0b c\x1cd \x0b e\tf", "line\n\nline\n \nline\nother", "é# ü* 😀$ " * 9, prose(r, 5000) + phrase * 3, " \n lead",
             "a b a b a b a b a b a b a b a b a b a b a b"]
    rows = [(k, t, None if k % 2 else "en") for k, t in enumerate(texts)] + [(None, "null id", "en"), (3, texts[3], "en")]
    found = rules.judged(docs_frame(spark, rows), labels_frame(spark, []))
    got = sorted(((x.doc_id, x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed, x.kept) for x in found.collect()), key=repr)
    want = [(i, *base_counts(t), not base_counts(t)[5]) for i, t, _ in rows]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("n,k,p", [(10, 0, 0.05), (1000, 2, 0.008), (1000, 20, 0.03), (50_000, 380, 0.008), (400, 400, 0.1)])
def test_binomial_tail(spark, n, k, p):
    def term(i):
        return math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p))
    want = math.fsum(term(i) for i in range(k + 1))
    got = spark.range(1).select(rules.binomial_tail(F.lit(float(n)), F.lit(k).cast("long"), p)).first()[0]
    assert got == pytest.approx(min(1.0, want), rel=1e-9, abs=1e-12)


def test_cutoffs_lose_few_good_documents(spark):
    r = random.Random(2)
    rows = [(k, prose(r, 60), "en") for k in range(2500)]
    rows += [(5000 + k, prose(r, 60).replace(" ", "$$$ "), "en") for k in range(60)]
    rows += [(6000, prose(r, 60), "xx"), (6001, prose(r, 60).replace(" ", "$$$ "), "xx")]  # a stratum without labels
    labels = [(k, 1, 0) for k in range(2500)] + [(5000 + k, 0, 0) for k in range(20)] + [(0, 0, 0), (1, None, 0), (None, 1, 0), (7, 1, 0)]
    docs = docs_frame(spark, rows)
    found = {x.doc_id: x.kept for x in rules.judged(docs, labels_frame(spark, labels)).collect()}
    assert not any(found[5000 + k] for k in range(60))
    assert sum(not found[k] for k in range(2500)) <= 2
    assert found[6000] and found[6001]
    kept = rules.kept_documents(docs, labels_frame(spark, labels))
    assert kept.columns == docs.columns
    assert {x.doc_id for x in kept.collect()} == {i for i, k in found.items() if k}
    few = rules.judged(docs, labels_frame(spark, labels[:20]))
    assert few.filter("not kept").count() == 0


def test_native_plan_has_no_python(spark):
    plan = rules.judged(docs_frame(spark, [(1, "a", "en")]), labels_frame(spark, []))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_classifier_on_held_out_rows(spark):
    r = random.Random(3)
    rows = [(k, prose(r, 80) if k % 3 else prose(r, 80).replace(" ", " | "), "en") for k in range(600)]
    rows += [(900, None, None), (901, "", "en"), (None, prose(r, 50), "en"), (4, rows[4][1], "en"), (902, "w " * 100_000, "en")]
    labels = [(k, int(k % 3 > 0), 0) for k in range(600)] + [(1, 1, 0), (2, 0, 0), (None, 1, 0), (5, None, 0)]
    found = classifier.scored(docs_frame(spark, rows), labels_frame(spark, labels)).collect()
    assert len(found) == len(rows)
    for x in found:
        assert x.held_out == (x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 5 == 0)
        assert 0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3)
    held = [x for x in found if x.held_out and x.doc_id < 600]
    assert sum(x.predicted == int(x.doc_id % 3 > 0) for x in held) >= 0.97 * len(held)
    docs = docs_frame(spark, rows)
    kept = classifier.kept_documents(docs, labels_frame(spark, labels))
    assert kept.columns == docs.columns
    assert Counter(x.doc_id for x in kept.collect()) == Counter(x.doc_id for x in found if x.predicted)


def test_classifier_does_not_depend_on_row_order(spark):
    r = random.Random(5)
    rows = [(k % 150, prose(r, 60) if k % 3 else prose(r, 60).replace(" ", " | "), "en") for k in range(400)]  # ids with several texts
    labels = [(k, int(k % 3 > 0), 0) for k in range(150)]
    seen = []
    for order in (rows, rows[::-1], sorted(rows, key=lambda x: x[1])):
        found = classifier.scored(docs_frame(spark, order).repartition(3), labels_frame(spark, labels)).collect()
        seen.append(sorted((x.doc_id, round(x.score, 9)) for x in found))
    assert seen[0] == seen[1] == seen[2]


def test_threshold_is_the_best_cut_over_all_labels(spark):
    r = random.Random(6)
    rows = [(k, prose(r, 40) if r.random() < 0.8 else prose(r, 40).replace(" ", " | "), "en") for k in range(500)]
    labels = {k: int(("|" not in rows[k][1]) ^ (r.random() < 0.1)) for k in range(500)}
    docs, known = docs_frame(spark, rows), labels_frame(spark, [(k, q, 0) for k, q in labels.items()])
    model = classifier.learn(docs, known, sample=40)
    used = [k for k in labels if zlib.crc32(str(k).encode()) % 5]
    s = dict(zip(used, model.strengths([rows[k][1] for k in used])))

    def balance(cut):
        return sum(np.mean([(s[k] >= cut) == bool(q) for k in used if labels[k] == q]) for q in (0, 1))
    best = max(balance(c) for c in s.values())
    assert balance(model.threshold) >= best - 0.01


def test_pairwise_weights_minimise_the_loss():
    draw = np.random.default_rng(2)
    good, bad = draw.normal(0.6, 1, (50, 4)), draw.normal(0, 1, (30, 4))
    model = classifier.fit(good, bad)
    g, b = model.terms(good), model.terms(bad)
    pairs = np.arange(50 * classifier.RIVALS)
    d = g[pairs % 50] - b[(pairs + pairs // 50 * 7919) % 30]

    def loss(w):
        return np.logaddexp(0, -d @ w).mean() + classifier.RIDGE * (w @ w) / 2
    least = loss(model.weights)
    assert all(loss(model.weights + step) >= least for step in draw.normal(0, 0.01, (200, len(model.weights))))


def test_classifier_without_labels(spark):
    docs = docs_frame(spark, [(1, "a b", "en")])
    assert classifier.scored(docs, labels_frame(spark, [])).first().score == 0.5
    assert classifier.scored(docs, labels_frame(spark, [(1, 1, 0)])).first().predicted == 1


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    found = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            checks = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                      "card": 16 <= len(digits) <= 19 and pii.luhn(digits), "phone": 8 <= len(digits) <= 15}
            if checks[kind]:
                found.append((kind, *m.span()))
    return found


def test_base_spans_match_the_patterns():
    r = random.Random(4)
    for _ in range(3000):
        text = "".join(r.choice(["a", ".", "@", "1", "25", "-", " ", "+", "1.2.3.4", "4539578763621486", "()", "é", "@b.c", "%", "300"]) for _ in range(r.randint(0, 40)))
        assert [(k, *s) for k, found in pii.base_spans(text).items() for s in found] == brute_spans(text)


@pytest.mark.parametrize("text,kind,covered", [
    ("write john (at) example (dot) com now", "email", "john (at) example (dot) com"),
    ("john [at] mail dot example dot org", "email", "john [at] mail dot example dot org"),
    ("ask ｊohn＠ｅxample．com", "email", "ｊohn＠ｅxample．com"), ("me@ex\u0430mple.com", "email", "me@ex\u0430mple.com"),
    ("no ４１１１ １１１１ １１１１ １１１１.", "card", "４１１１ １１１１ １１１１ １１１１"),
    ("call +1 five five five one two three four five six seven ok", "phone", "+1 five five five one two three four five six seven"),
])
def test_disguises_are_found(text, kind, covered):
    spans = pii.all_spans(text)[1]
    assert [text[a:b] for a, b in spans[kind]] == [covered]
    assert pii.mask_text(text) == text.replace(covered, f"<{kind}>")


@pytest.mark.parametrize("text, kind, covered", [
    ("mail jane@example[dot]com now", "email", "jane@example[dot]com"),
    ("jane@example dot com", "email", "jane@example dot com"),
    ("jane[@]example.com", "email", "jane[@]example.com"),
    ("host 10[.]20[.]30[.]40", "ip", "10[.]20[.]30[.]40"),
    ("JANE@EXAMPLE DOT COM", "email", "JANE@EXAMPLE DOT COM"),
    ("to jane@exa\u200bmple.com ok", "email", "jane@exa\u200bmple.com"), ("to jane\u00ad@example.com", "email", "jane\u00ad@example.com"),
    ("at 10 dot 1 dot 2 dot 3 now", "ip", "10 dot 1 dot 2 dot 3"),
    ("call plus one five five five one two three four five six seven.", "phone", "plus one five five five one two three four five six seven"),
    ("see \U0001d4bf\U0001d44e\U0001d45b\U0001d452@ex\u24d0mple.com", "email", "\U0001d4bf\U0001d44e\U0001d45b\U0001d452@ex\u24d0mple.com"),
])
def test_disguises_stand_on_their_own(text, kind, covered):
    assert [text[a:b] for a, b in pii.all_spans(text)[1][kind]] == [covered]
    assert pii.mask_text(text) == text.replace(covered, f"<{kind}>")


@pytest.mark.parametrize("text, base, longer", [
    ("jane@mail.example[dot]com now", "jane@mail.example", "jane@mail.example[dot]com"), ("\U0001d4bfane@example.com", "ane@example.com", "\U0001d4bfane@example.com"),
    ("ja\u00adne@example.com", "ne@example.com", "ja\u00adne@example.com"),
])
def test_base_spans_stay_beside_longer_ones(text, base, longer):
    found = pii.all_spans(text)
    assert [text[a:b] for a, b in found[0]["email"]] == [base]
    assert sorted(text[a:b] for a, b in found[1]["email"]) == sorted([base, longer])
    assert pii.mask_text(text) == text.replace(longer, "<email>")


@pytest.mark.parametrize("text", ["", "we met at ten. dot the i", "one two three four five", "1 dot 2 dot 3", "plus one two", "a\u00adb so\u200b", "look at this dot", "<at> . dot", "ÉÀÜß ñ at a dot", "(at) (dot)"])
def test_plain_text_is_left_alone(text):
    assert pii.all_spans(text)[1] == {k: [] for k in pii.KINDS}
    assert pii.mask_text(text) == text


def test_long_runs_are_quick():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 200_000, "+1" + " " * 300_000, "a@" * 150_000, "one " * 60_000, " dot a" * 50_000, "(at)" * 50_000):
        pii.all_spans(text)


def test_disguise_does_not_hang_on_words_elsewhere():
    row = "4539578763621486 eight_"
    alone, beside = pii.all_spans(row)[1], pii.all_spans(f"one\n{row}")[1]
    assert alone["card"] == [(0, 16), (0, 22)] and beside["card"] == [(4, 20), (4, 26)]


def test_rare_look_alikes_are_told_from_other_characters():
    chars, plain = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000], pii.look_alikes()
    assert pii.plain_characters(pii.Traced.of("".join(chars))).text == "".join(plain.get(c, c) for c in chars)


def _seconds(run):
    best = float("inf")
    for _ in range(3):
        start = time.process_time()
        run()
        best = min(best, time.process_time() - start)
    return best


def test_accented_text_costs_a_few_scans():
    text, scan = "de aiè ñandú Óími crème œuvre quelqu’un " * 10_000, re.compile("[0-9]")
    assert _seconds(lambda: pii.all_spans(text)) < 40 * _seconds(lambda: scan.search(text))


def test_personal_data_rows(spark):
    rows = [(1, "a@b.cc 1.2.3.4", "en"), (1, "a@b.cc 1.2.3.4", "en"), (2, None, "en"), (None, "me (at) b (dot) cc", "en"), (3, "", None)]
    docs = docs_frame(spark, rows)
    found = [tuple(x) for x in pii.personal_data(docs).collect()]
    want = []
    for i, t, _ in rows:
        base, spans = pii.all_spans(t or "")
        joined = [",".join(f"{k}:{a}:{b}" for k in pii.KINDS for a, b in s[k]) for s in (base, spans)]
        want.append((i, *[len(spans[k]) for k in pii.KINDS], sha(joined[0]), joined[1]))
    assert sorted(found, key=repr) == sorted(want, key=repr)
    out = pii.masked(docs)
    assert out.columns == docs.columns
    assert sorted((x.text for x in out.collect()), key=repr) == sorted(["<email> <ip>"] * 2 + [None, "<email>", ""], key=repr)
    assert pii.personal_data(docs.limit(0)).count() == 0


def chats(spark, rows):
    return spark.createDataFrame([(*r, "t", 1) for r in rows], "conv_id long, turn long, role string, text string, tree string, depth int")


def test_conversations_round_trip(spark):
    odd = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<\\\\|im_start|> <|im_start", "", None, "line\nline\n", "x" * 50_000]
    rows = [(1, k, ["user", "assistant"][k % 2], t) for k, t in enumerate(odd)]
    rows += [(2, 5, "user", "a"), (2, 5, "assistant", "b"), (2, 5, "assistant", "b"), (None, 0, "user", "n"), (3, None, None, "q"), (4, 0, "ro\\le\nx<|im_end|>", "z")]
    out = chat.formatted(chat.linear_tree(chat.with_probe(chats(spark, rows))))
    got = {x.conv_id: tuple(x)[1:] for x in chat.read_back(out).collect()}
    said = "<|im_end|><|im_start|>assistant ok"
    every = [*rows, (-1, 0, "user", said), (-1, 1, "assistant", said)]
    convs = {}
    for c, turn, role, text in every:
        convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns = [x[2:] for x in sorted(turns)]
        learned = "".join(t for role, t in turns if role == "assistant")
        formatted = "".join(chat.format_turn(*t) for t in turns)
        assert got[c] == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)), len(learned), sha(learned), len(formatted))
    assert chat.read_back(chat.formatted(chat.linear_tree(chats(spark, [])))).count() == 0


def test_branches_of_reply_trees(spark):
    r = random.Random(8)
    rows = []
    for tree in range(6):
        for node in range(25):
            rows.append((tree, node, None if node == 0 else r.randrange(max(0, node - 4), node), "user", f"{tree}.{node}", float(r.randrange(5))))
    rows += [(7, n, n - 1 if n else None, "user", str(n), 1.0) for n in range(70)]  # a chain
    rows += [(8, 1, 99, "user", "parent missing", None), (8, 2, None, "user", "other root", 1.0)]
    rows += [(9, 1, 2, "user", "cycle", 1.0), (9, 2, 1, "user", "cycle", 1.0), (9, 3, None, "user", "root", 1.0)]
    messages = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    got = {}
    for x in chat.branches(messages, best=3).collect():
        got.setdefault((x.tree, x.branch), []).append((x.depth, x.node))
    want = {}
    for tree in {x[0] for x in rows}:
        own = {x[1]: x for x in rows if x[0] == tree}
        paths = []
        for leaf in set(own) - {x[2] for x in own.values()}:
            path, at, ok = [], leaf, True
            while at in own:
                if at in path:
                    ok = False
                    break
                path.append(at)
                at = own[at][2]
            if ok:
                paths.append((-sum(own[n][5] or 0.0 for n in path), leaf, path[::-1]))
        for rank, (_, _, path) in enumerate(sorted(paths)[:3], 1):
            want[tree, rank] = [(k + 1, n) for k, n in enumerate(path)]
    assert {k: sorted(v) for k, v in got.items()} == want


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def test_url_rules(spark):
    pages = [(1, "http://A.Example.ORG/es/1?x"), (2, "https://example.org/en/12#t"), (3, "https://xexample.org/es/1"), (4, "http://org"), (5, None),
             (6, "no scheme/x"), (7, "http://b.com/de/5"), (8, "http://b.com/fr/5"), (9, "http://b.com/en/5"), (None, "x://?q"), (1, "http://A.Example.ORG/es/1?x"), (10, "")]
    frame = spark.createDataFrame([(*p, "h", 0) for p in pages], "page_id long, url string, host string, n int")
    found = Counter(tuple(x)[:4] for x in urls.judged_urls(frame, RULES).collect())
    want = Counter([(1, "a.example.org", "/es/1", "example.org/es/"), (2, "example.org", "/en/12", "example.org/en/1"), (3, "xexample.org", "/es/1", "org/"),
                    (4, "org", "", None), (5, "", "", None), (6, "", "", None), (7, "b.com", "/de/5", "com/de/"), (8, "b.com", "/fr/5", "com/fr/"),
                    (9, "b.com", "/en/5", None), (None, "", "", None), (1, "a.example.org", "/es/1", "example.org/es/"), (10, "", "", None)])
    assert found == want
    assert urls.judged_urls(frame.limit(0), RULES).count() == 0


def test_url_templates_follow_their_labels(spark):
    rows = [(k, f"http://h{k % 3}.net/{'bad' if k % 2 else 'good'}/{k}") for k in range(600)]
    rules_ = [("block", f"h{h}.net", "/bad/1") for h in range(3)] + [("allow", f"h{h}.net", "/good/1") for h in range(3)] + [("allow", f"h{h}.net", "/good/2") for h in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    found = urls.judged_urls(pages, rules_).filter("rule is null").collect()
    assert found and all(x.verdict == ("block" if "/bad/" in x.path else "allow") for x in found)
    assert all(x.verdict == "allow" for x in urls.judged_urls(pages, []).collect())
