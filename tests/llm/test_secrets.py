import hashlib
import math
import random
import re
import time

from weekshare.llm import secrets as S

from .cases import documents, mixed

HEXKEY = "9f8a7b6c5d4e3f2a1b0c9d8e7f6a5b4c"
KEY = "AKIA" + "Q7ZP2MX4TR9WB1KD"


def literal_base(text):
    """The contract's rule, word for word."""
    out = []
    for kind, pattern, least, group in (
            ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 1),
            ("access", r"AKIA[A-Z0-9]+", 20, 0), ("hex", r"[0-9a-f]+", 24, 0)):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text, re.ASCII)
                if len(m.group(group)) >= least]
    order = ("assign", "access", "hex")
    return sorted(out, key=lambda x: (x[0], order.index(x[1])))


def test_base_patterns_follow_the_rule():
    rng = random.Random(3)
    bits = ["token", "Password", "api_key", "apiKEY", "secret", "=", ":", " ", '"', "'", "abc", "abcdef0123456789",
            HEXKEY, KEY, "AKIA", "AKIAAKIA", "é", "\n", "ſecret", "a.b_c=d", "0" * 23]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(0, 14)))
        got = [(a, S.KINDS[k], b) for a, k, b in S.base_spans(text)]
        assert got == literal_base(text), text


def test_incremental_entropy_equals_direct():
    rng = random.Random(5)
    for _ in range(200):
        s = "".join(rng.choice("abcdefABCDEFghXYZ0123456789+/_-") for _ in range(rng.randrange(1, 70)))
        flags = set()
        for i in range(len(s) - S.WINDOW + 1):
            w = s[i:i + S.WINDOW]
            h = -sum(w.count(c) / len(w) * math.log2(w.count(c) / len(w)) for c in set(w))
            kind = S._class_of(sum(map(str.isalpha, w)), sum(map(str.isdigit, w)),
                               sum(c not in S.HEX_CHARS for c in w), sum(not c.isalnum() for c in w))
            if kind and h >= S.THRESHOLDS[kind] - 1e-9:
                flags |= set(range(i, i + S.WINDOW))
        got = set()
        for a, b in S.entropy_windows(s):
            got |= set(range(a, b))
        assert got == flags


def test_entropy_layer_finds_keys_and_spares_words():
    assert [k for _, k, _ in S.all_spans("x q8Zr4TmW2pLx9VbN6cKdYh3s y")[1]] == [3]
    for plain in ("Donaudampfschifffahrtsgesellschaft", "src/main/resources/config/base",
                  "123e4567-e89b-12d3-a456-426614174000", "=" * 40, "2021-12-03-2021-12-04-20"):
        assert S.all_spans(plain)[1] == []
    base, spans = S.all_spans(f'token = "{HEXKEY}"')
    assert base == spans, "a span inside a base span adds nothing"


def test_allow_list_is_linear():
    name = "test_returns_none_when_the_input_is_empty_twice"
    long = [f"a-lower-case-slug-of-{n}-words-" * 2 for n in (3, 60)]
    long += [name, name + "_and_once_more_for_luck_2", "a" * 28 + "1", "a" * 5000 + "1", "abc/" * 2000 + "+"]
    start = time.process_time()
    for text in long:
        S.all_spans(text)
    assert time.process_time() - start < 2
    assert S.PATH.fullmatch("src/main2/x") and S.PATH.fullmatch("/a-abc_1/2/") and not S.PATH.fullmatch("ab1/abc")


def test_long_pieces_and_many_spans_are_linear():
    for n in (10_000, 1_000_000):
        start = time.process_time()
        piece = "abc/" + "q" * n + "1a1/" + "n7x2k9q4w8z3v6m1p5"
        assert "n7x2k9q4w8z3v6m1p5" not in S.redact(piece)
        assert time.process_time() - start < 3
    pair = f"token={HEXKEY} q8Zr4TmW2pLx9VbN6cKdYh3s "
    start = time.process_time()
    base, spans = S.all_spans(pair * (1_000_000 // len(pair)))
    assert time.process_time() - start < 4
    assert len(spans) - len(base) == 1_000_000 // len(pair)


def test_plain_pieces_are_the_stated_forms():
    rng = random.Random(11)
    for _ in range(4000):
        s = "".join(rng.choice("ab1") for _ in range(rng.randrange(1, 9)))
        want = len(re.findall("[0-9]+", s)) <= 1 or re.fullmatch("[0-9]+[a-z]+[0-9]+", s) is not None
        assert bool(S.PLAIN_PIECE.fullmatch(s)) == want, s


def test_entropy_spans_inside_base_spans_add_nothing():
    rng = random.Random(13)
    bits = [f"token={HEXKEY}", HEXKEY, KEY, "q8Zr4TmW2pLx9VbN6cKdYh3s", " ", "-", "secret: q8Zr4TmW2pLx9VbN6cKd", "/"]
    for _ in range(500):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 12)))
        base, spans = S.all_spans(text)
        keys = [(a + m.start(), 3, b + m.start()) for m in S.CANDIDATE.finditer(text)
                for a, b in S.key_spans(m.group())]
        assert spans == sorted(base + [k for k in keys if not any(x <= k[0] and k[2] <= y for x, _, y in base)])


def test_keys_behind_paths_and_whole_keys():
    text = "see hooks/services/t024be7lh/n7x2k9q4w8z3v6m1p5 there"
    assert S.redact(text) == "see hooks/services/[SECRET]/[SECRET] there"
    for key in ("wJalrXUtnFEMIqKzMDENGxbPxR8f4C2YE7aMpL5k", "q8Zr4TmW2pLx9VbN6cKdwJalrXUtnFEMIqKzMDEN",
                "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"):
        assert S.redact(f"x {key}== y") == "x [SECRET] y", key
    for plain in ("usr/lib/python3/dist-packages/k8s/v1beta1/utf8", "blog/how-to-earn-10k-a-month-in-2021/page2",
                  "orders/123e4567-a89b-12d3-a456-426614174000/items", "images/1920x1080/section10/photo-3"):
        assert S.all_spans(plain)[1] == [], plain


def test_no_flagged_window_is_lost_outside_paths():
    rng = random.Random(7)
    for _ in range(500):
        s = "".join(rng.choice("abcdefABCXYZ0123456789+/_-=") for _ in range(rng.randrange(20, 90)))
        spans = S.key_spans(s)
        assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))
        if not S.allowed(s) and not S.PATH.fullmatch(s):
            assert all(any(x <= a and b <= y for x, y in spans) for a, b in S.entropy_windows(s))


def test_redaction():
    text = f'a token = "{HEXKEY}" b {KEY} c'
    assert S.redact(text) == 'a [SECRET]" b [SECRET] c'
    assert S.redact("plain words") == "plain words"
    assert S.all_spans(S.redact(text))[1] == []


def test_query_cases(spark):
    texts = [*mixed(), f"token={HEXKEY}", f"😀 {KEY} {HEXKEY}"]
    got = {r.doc_id: r for r in S.scan_secrets(documents(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = literal_base(t or "")
        joined = ",".join(f"{k}:{a}:{b}" for a, k, b in want)
        assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(got[i].spans.split(","))
        assert got[i].n_hex == sum(k == "hex" for _, k, _ in want)
    assert S.scan_secrets(documents(spark, [])).count() == 0
    assert S.scan_secrets(documents(spark, ["a", "b"], [None, None])).count() == 2


def test_redact_keeps_rows_and_columns(spark):
    docs = documents(spark, [*mixed(), f"my token={HEXKEY}"])
    out = S.redact_secrets(docs)
    assert out.schema == docs.schema
    rows = {r.doc_id: r for r in out.collect()}
    last = rows[max(rows)]
    assert last.text == "my [SECRET]" and last.n_chars == len(last.text)
    assert rows[40].text is None
