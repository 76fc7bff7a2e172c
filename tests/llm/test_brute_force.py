"""The operators against plain versions, on the small table and on made-up texts."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tillstream.llm import bpe, decontaminate, jaccard_join, language, licenses, mixing, order_minhash, pii, quality
from tillstream.llm.batches import Words, byte_class
from tillstream.llm.components import components
from tillstream.llm.queries import QUERIES, documents


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r["doc_id"]: r["text"] for r in documents(spark, sf_dir).collect()}


def answers(spark, sf_dir, name):
    return {r["doc_id"]: r for r in QUERIES[name](spark, sf_dir).collect()}


def folded(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_licenses(spark, sf_dir, texts):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    for i, row in answers(spark, sf_dir, "op1_licenses").items():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded(texts[i]))
        places, labels = [], set()
        for phrase, label in phrases.items():
            p = phrase.split()
            hits = [k for k in range(len(words)) if words[k : k + len(p)] == p]
            places += hits
            labels |= {label} if hits else set()
        assert (row["n_words"], row["n_base"], row["base_labels"]) == (len(words), len(places), ",".join(sorted(labels)))
        assert (row["first_word"], row["last_word"]) == (min(places, default=None), max(places, default=None))
        assert labels <= set(row["labels"].split(",")) | {""} - {""} or not labels


@pytest.mark.parametrize(
    ("expression", "order", "allowed"),
    [
        ("MIT", "mit", True), ("GPL-2.0-only OR MIT", "gpl-2.0-only mit OR", True), ("GPL-2.0-only AND MIT", "gpl-2.0-only mit AND", False),
        ("MIT OR GPL-2.0-only AND GPL-3.0-only", "mit gpl-2.0-only gpl-3.0-only AND OR", True),
        ("(MIT OR GPL-2.0-only) AND GPL-3.0-only", "mit gpl-2.0-only OR gpl-3.0-only AND", False),
        ("GPL-2.0-only WITH Classpath-exception-2.0 and isc", "gpl-2.0-only classpath-exception-2.0 WITH isc AND", True),
    ],
)
def test_expressions(expression, order, allowed):
    parts = licenses.postfix(expression)
    assert " ".join(parts) == order and licenses.permissive(parts) is allowed


@pytest.mark.parametrize("expression", ["", "AND", "MIT OR", "(MIT", "MIT)", "MIT ISC", "()", "MIT ** ISC"])
def test_no_expressions(expression):
    with pytest.raises(ValueError):
        licenses.postfix(expression)


def test_tags_in_text():
    row = licenses.scan(b"x\nSPDX-License-Identifier: MIT OR GPL-2.0-only */\nMIT license. cc by CC-BY 4.0")
    assert row[1:6] == (3, 10, 14, "cc-by,mit", "cc-by,gpl-2.0-only,mit") and row[7:] == ("mit gpl-2.0-only OR", True)


def test_held_out_language(spark, sf_dir):
    want = {r["doc_id"]: r["lang"] for r in documents(spark, sf_dir).collect()}
    found = answers(spark, sf_dir, "op2_language")
    held = [i for i, r in found.items() if r["held_out"]]
    assert held and sum(found[i]["lang_pred"] == want[i] for i in held) >= 0.97 * len(held)


def test_filters_return_all_languages():
    draw = np.random.default_rng(1)
    grams = {k: draw.integers(1, 2**63, 500).astype(np.uint64) for k in ("a", "b", *(f"x{i}" for i in range(70)))}
    grams["b"] = np.concatenate([grams["b"], grams["a"][:100]])
    filters = language.Filters(sorted(grams), grams)
    names = filters.languages
    shares = filters.shares(grams["a"], np.zeros(500, np.int64), 1)[0]
    assert shares[names.index("a")] == 1 and abs(shares[names.index("b")] - 0.2) < 0.03
    assert max(s for n, s in zip(names, shares, strict=True) if n not in "ab") < 0.05


def test_held_out_quality(spark, sf_dir):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    found = answers(spark, sf_dir, "op5_quality")
    marked = [i for i in labels if i in found]
    right = sum(found[i]["predicted"] == labels[i] for i in marked)
    assert right >= 0.9 * len(marked)


def test_risk_separates_two_kinds():
    draw = np.random.default_rng(2)
    good, bad = draw.normal(0, 1, (9000, quality.N_FEATURES)), draw.normal(0, 1, (2000, quality.N_FEATURES))
    good[:, 10:], bad[:, 10:] = 0, 0  # ten of the features tell something
    bad[:, 3] += 6
    unlabelled = np.concatenate([good[3000:6000], bad[:1000]])
    model = quality.Classifier(good[:3000], unlabelled, prior=0.75)
    assert np.mean(model.score(good[6000:]) >= 0.7) > 0.9 and np.mean(model.score(bad[1000:]) < 0.7) > 0.9


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, m.end()))
    return sorted(out)


def test_personal_data(spark, sf_dir, texts):
    for i, row in answers(spark, sf_dir, "op7_personal_data").items():
        base = plain_spans(texts[i] or "")
        shown = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert row["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == n for s in base) for n in range(4)]
        assert set(filter(None, shown.split(","))) <= set(row["spans"].split(","))


def test_base_detectors_on_noise():
    draw = random.Random(1)
    for _ in range(5000):
        text = "".join(draw.choice("a.@-1 +2()%_0é\n5") for _ in range(draw.randint(0, 60)))
        text += draw.choice(["", " 4111 1111 1111 1111 1.2.3.4.255.6.7.8 a@b.c@d.e", "4111-1111-1111-1111+12 (345) 678.9012"])
        assert pii.detect(text) == plain_spans(text)


@pytest.mark.parametrize(
    ("text", "kind", "part"),
    [
        ("mail bob [at] mail (dot) com now", "email", "bob [at] mail (dot) com"), ("x jоhn@mаil.com y", "email", "jоhn@mаil.com"),
        ("ann dot lee at mail dot example dot com!", "email", "ann dot lee at mail dot example dot com"),
        ("call plus one two three four five six seven eight nine zero one.", "phone", "plus one two three four five six seven eight nine zero one"),
        ("card four one one one 1111 1111 one one one one", "card", "four one one one 1111 1111 one one one one"),
        ("host 192[.]168[.]0[.]1", "ip", "192[.]168[.]0[.]1"), ("a​b@c.com", "email", "a​b@c.com"),
    ],
)
def test_disguises(text, kind, part):
    base, every = pii.spans(text)
    a = text.index(part)
    assert (a, pii.KINDS.index(kind), a + len(part)) in every
    assert pii.masked(text, every) == text.replace(part, f"[{kind.upper()}]")


@pytest.mark.parametrize("text", ["it was at once the dot", "meet at noon", "one two buckle my shoe", "Él está aquí a las 3.5"])
def test_clean_texts_stay(text):
    assert pii.spans(text)[1] == []


def test_token_counts(spark, sf_dir, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, row in answers(spark, sf_dir, "op8_token_counts").items():
        want = len(tokenizer.encode(texts[i] or "", add_special_tokens=False).ids)
        assert (row["n_tokens"], row["n_bytes"], row["over_limit"]) == (want, len((texts[i] or "").encode()), want > 1024)
    pieces = bpe.pieces(public_tokenizers.path("byte_bpe_50k.json"))
    draw = random.Random(3)
    for _ in range(2000):
        text = "".join(draw.choice(["a", "the", " ", "  ", "\n", "'s", "'LL", "1²", "é", "日本", "🙂", "\x1c", "\xa0", "<|endoftext|>", "!!", "ab"]) for _ in range(20))
        assert pieces.count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids), repr(text)


def test_fingerprints(spark, sf_dir, texts):
    found = answers(spark, sf_dir, "op10_fingerprints")
    order = sorted(texts, reverse=True)
    for i, after in zip(order, order[1:] + order[:1], strict=True):
        new = order_minhash.edited(texts[i], texts[after])
        own, other, following = (order_minhash.fingerprint(t) for t in (texts[i], new, texts[after]))
        row = found[i]
        assert row["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest() and row["n_chars"] == len(texts[i])
        assert row["fingerprint"] == order_minhash.shown(own) and row["edited_fingerprint"] == order_minhash.shown(other)
        assert (row["near_edited"], row["near_next"]) == (np.mean(own == other), np.mean(own == following))


def test_fingerprint_falls_with_edits():
    draw = random.Random(4)
    text = "".join(draw.choice("abcdefgh ") for _ in range(2000))
    near = []
    for share in (0, 0.01, 0.05, 0.3):
        changed = "".join(draw.choice("xyz") if draw.random() < share else c for c in text)
        near.append(order_minhash.likeness(order_minhash.fingerprint(text), order_minhash.fingerprint(changed)))
    assert near[0] == 1 and near == sorted(near, reverse=True) and near[-1] < 0.2


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_components(texts, size=4, percent=85):
    sets = {}
    for i, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", folded(text))
        sets[i] = {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()
    links = []
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            low, high = sorted((len(sets[a]), len(sets[b])))
            if low and 100 * low >= percent * high:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (low + high - both):
                    links.append((a, b))
    return sets, union_find(ids, links)


def test_jaccard_join(spark, sf_dir, texts):
    sets, want = plain_components(texts)
    found = answers(spark, sf_dir, "op4_jaccard_join")
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in found.items()} == {i: (len(sets[i]), want[i]) for i in sets}


def test_groups_of_near_copies(spark):
    """Copies at about the least similarity: pairs on both sides of it, chains, and copies of copies."""
    draw = random.Random(5)
    texts = {}
    for group in range(3):
        base = [f"w{draw.randrange(10**6)}" for _ in range(120)]
        for k in range(60):
            words = list(base if k % 3 else texts.get(1000 * group + k - 1, " ".join(base)).split())
            for _ in range(draw.choice([0, 1, 2, 3, 4, 5])):
                words[draw.randrange(len(words))] = f"e{draw.randrange(10**6)}"
            texts[1000 * group + k] = " ".join(words[: draw.choice([None, None, -1, -6])])
    sets, want = plain_components(texts)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard_join.classes(docs).collect()}
    assert found == want and 3 < len(set(want.values())) < 180


def test_prefix_bounds_lose_no_link():
    draw = random.Random(6)
    for n in [*range(1, 60), 100, 333, 1000]:
        tokens = np.asarray([draw.getrandbits(63) for _ in range(2 * n)], np.uint64)
        for _ in range(5):
            a = set(tokens[:n].tolist())
            b = set(list(a)[: max(1, (85 * n + 99) // 100)])
            if 100 * len(a & b) < 85 * len(a | b):
                continue
            kept = []
            for s in (a, b):
                x = np.asarray(sorted(s), np.uint64)
                first = set(jaccard_join._least(x, int(jaccard_join.extended(len(x))), jaccard_join.FIRST).tolist())
                kept.append(set(sorted(first)[: jaccard_join.kept(len(x))]))
            assert kept[0] & kept[1]


def test_components(spark):
    draw = random.Random(7)
    links = [(i, i + 1) for i in range(0, 300, 2)] + [(draw.randrange(2000), draw.randrange(2000)) for _ in range(900)] + [(5000 + i, 5001 + i) for i in range(40)]
    want = union_find({x for p in links for x in p}, links)
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {n: r for n, r in want.items() if any(n in p and p[0] != p[1] for p in links)}


def test_decontamination(spark, sf_dir, texts):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    words = lambda t: " " + " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded(t))) + " "
    plain = {i: words(t) for i, t in texts.items()}
    want = {(i, k) for k, item in items.items() for i, t in plain.items() if words(item) in t}
    found = {(r["doc_id"], r["item_id"]) for r in QUERIES["op3_decontamination"](spark, sf_dir).collect()}
    assert want <= found
    # A recall of 0.9 and more at random edits within the bound, and nothing beyond it.
    draw = np.random.default_rng(8)
    block = decontaminate.Items(list(items), list(items.values()), 0.8, 0.99)
    hit = 0
    for k, item in enumerate(block.words):
        around = draw.integers(1, 2**62, 200).astype(np.uint64)
        edited = decontaminate.edited_at_random(item, block.edits[k], draw)
        text = np.concatenate([around[:100], edited, around[100:]])
        hit += any(m[1] == k for m in decontaminate.matches(text, np.asarray([0, len(text)]), block))
        far = decontaminate.edited_at_random(item, len(item), draw)
        text = np.concatenate([around[:100], far, around[100:]])
        for m in decontaminate.matches(text, np.asarray([0, len(text)]), block):
            assert m[2] <= block.edits[m[1]]
    assert hit >= 0.9 * len(block.words)


def test_best_fit():
    draw = random.Random(9)
    for _ in range(200):
        item, text = ([draw.randrange(4) for _ in range(draw.randint(1, 8))] for _ in range(2))
        best = min(levenshtein(item, text[a:b]) for a in range(len(text) + 1) for b in range(a, len(text) + 1))
        distance, a, b = decontaminate.best_fit(np.asarray(item), np.asarray(text))
        assert distance == best == levenshtein(item, text[a:b])


def levenshtein(x, y):
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return row[-1]


def test_repeated_passages(spark):
    draw = random.Random(10)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(5))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(55) for _ in range(20)]
    texts, planted = {}, defaultdict(set)
    for i in range(80):
        which = draw.randrange(20) if i < 60 else None
        texts[i] = f"{prose(40)} {passages[which]} {prose(30)}\n{prose(25)}" if which is not None else prose(150)
        if which is not None:
            planted[which].add(i)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    from tillstream.llm import paragraphs

    found = paragraphs.repeats(docs).collect()
    expected = {i for ids in planted.values() if len(ids) > 1 for i in ids}
    assert {r["doc_id"] for r in found} == expected
    for r in found:
        assert 35 <= r["first_word"] and r["end_word"] <= 100
        assert r["removed"] == (r["keeper"] != r["doc_id"]) and r["keeper"] in expected
    # Paragraphs that differ in a word at their end.
    base = prose(60)
    near = spark.createDataFrame([(1, base), (2, base + " more"), (3, prose(60))], "doc_id bigint, text string")
    assert {r["doc_id"] for r in paragraphs.repeats(near).collect()} == {1, 2}


def test_mixture(spark, sf_dir):
    docs = documents(spark, sf_dir)
    taken = mixing.mixture(docs, share=0.5).collect()
    tokens = {r["doc_id"]: len(re.findall(r"\S+", r["text"])) for r in docs.collect()}
    total = sum(tokens.values())
    assert all(r["n_tokens"] == tokens[r["doc_id"]] for r in taken)
    assert 0.48 * total <= sum(r["taken"] for r in taken) <= 0.5 * total
    assert max(r["epoch"] for r in taken) < mixing.EPOCHS
    assert sorted(map(tuple, taken)) == sorted(map(tuple, mixing.mixture(docs.repartition(3), share=0.5).collect()))


def pour(budget, nodes):
    """Plain water-filling over (supply, weight)."""
    given = [0.0] * len(nodes)
    left = [i for i, (s, w) in enumerate(nodes) if s > 0 and w > 0]
    while left and budget > 1e-9:
        total = sum(nodes[i][1] for i in left)
        full = [i for i in left if nodes[i][0] - given[i] <= budget * nodes[i][1] / total + 1e-9]
        if not full:
            for i in left:
                given[i] += budget * nodes[i][1] / total
            break
        for i in full:
            budget -= nodes[i][0] - given[i]
            given[i] = nodes[i][0]
        left = [i for i in left if i not in full]
    return given


def test_budgets_go_to_siblings_first(spark):
    draw = random.Random(11)
    weights = {"domain": {"a": 3.0, "b": 1.0}, "lang": {"en": 2.0, "xx": 0.0}}
    leaves = [(d, la, s, draw.randint(1, 1000)) for d in "abc" for la in ("en", "de", None, "xx") for s in ("s1", "s2", None) if draw.random() < 0.8]
    found = mixing.budgets(spark.createDataFrame(leaves, "domain string, lang string, source string, tokens bigint"), weights, 0.6, 2)
    found = {(r["domain"], r["lang"], r["source"]): r["given"] for r in found.collect()}
    want, current = {}, {(): 0.6 * sum(x[3] for x in leaves)}
    for depth, level in enumerate(mixing.LEVELS, 1):
        following = {}
        for parent, budget in current.items():
            names = sorted({x[:depth] for x in leaves if x[: depth - 1] == parent}, key=str)
            nodes = [(2 * sum(x[3] for x in leaves if x[:depth] == n), weights.get(level, {}).get(n[-1], 1.0)) for n in names]
            following |= dict(zip(names, pour(budget, nodes), strict=True))
        current = following
    want = current
    assert found.keys() == want.keys()
    assert all(abs(found[k] - want[k]) < 1e-3 for k in want)


def test_word_hashes():
    finder = Words(~byte_class((0x20, 0x20)))
    raw = np.frombuffer(b"Foo bar FOO  " + b"x" * 3_000_000 + b" foo", np.uint8)
    starts, ends, _ = finder.find(raw, np.asarray([0, 5, len(raw)]))
    h = finder.hashes(raw, starts, ends)
    assert [raw[a:b].tobytes()[:3] for a, b in zip(starts, ends, strict=True)] == [b"Foo", b"b", b"ar", b"FOO", b"xxx", b"foo"]
    assert h[0] == h[3] == h[5] and len(set(h.tolist())) == 4
