"""URL filter, quality rules, licence scan and secret scan against plain statements of their rules."""

import hashlib
import math
import random
import re
from collections import Counter

import public_tokenizers
from pyspark.sql import functions as F

from castwright.llm import catalog, license_scan, quality_rules, secret_scan, url_filter

SF = "/root/testdata/sf0.001"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    after = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", after)[0]
    path = re.match(r"[^?#]*", after[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule(host, path):
    fits = []
    for verdict, text in url_filter.RULES:
        h, _, p = text.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(text), text, verdict))
    return max(fits)[1:] if fits else (None, None)


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/en/12?x#y", "http://a.example.org/es/", "x://org/", "x://notorg/", "x://a.com/de/1/../", "x://a.com?/de/", "x://É.org/é", "a://b://c.org/d", "x://example.org/en/2", "x://u@a.com:80/fr/", "x://cheappills.net/q", "x://a.com/fr/\n1", "x://a.com/fr/1", "x://a.com/fr/1"]


def test_url_parts_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    for r in url_filter.judge(pages.select("page_id", "url")).collect():
        assert (r["host"], r["path"]) == parts(r["url"])
        text, verdict = rule(r["host"], r["path"])
        assert r["rule"] == text and r["verdict"] == (verdict or ("block" if r["block_odds"] > 0 else "allow"))
    assert url_filter.judge(pages.limit(0).select("page_id", "url")).count() == 0


def test_segmenter_splits_names():
    own = url_filter.Segmenter(public_tokenizers.path(url_filter.WORDS))
    assert own.words("cheappills.casinowin/free-bets/") == ["cheap", "pills", "casino", "win", "free", "bets"]
    assert own.words("") == [] and "".join(own.words("q" * 500)) == "q" * 500

    def best(name):
        if not name:
            return 0.0
        return min(own._price(name[:k]) + best(name[k:]) for k in range(1, len(name) + 1))

    for name in ("newsletter", "zxqtheman", "adultx"):
        assert abs(sum(map(own._price, own.cut(name))) - best(name)) < 1e-9


def test_bayes_blocks_unwanted_hosts(spark):
    out = catalog.op2_url_filter(spark, "/root/testdata/sf0.1").where("rule IS NULL")
    bad = F.col("host").rlike("casino|pills|bets|adult|ads-|spam")
    assert out.where(bad & (F.col("verdict") != "block")).count() == 0
    assert out.where(~bad & (F.col("verdict") == "block")).count() <= 0.02 * out.count()


def bayes_odds(rows):
    """Block odds of each (words, rule verdict), counted one by one."""
    label = [1 if {*w} & {*url_filter.SEEDS} else 0 if v != "block" else None for w, v in rows]
    counts = [Counter(w for (words, _), x in zip(rows, label) if x == v for w in words) for v in (0, 1)]
    size, total = len({*counts[0], *counts[1]}) + 1, [c.total() for c in counts]

    def odds(w):
        one, zero = (math.log((counts[v][w] + 1) / (total[v] + size)) for v in (1, 0))
        return one - zero if counts[0][w] + counts[1][w] else 0.0

    return [math.log((label.count(1) + 1) / (label.count(0) + 1)) + sum(map(odds, words)) for words, _ in rows]


def test_every_word_counts_in_both_classes(spark):
    words = sorted(w for w in url_filter.segmenter(public_tokenizers.path(url_filter.WORDS)).cost if len(w) > 3 and w not in url_filter.SEEDS)
    assert len(words) > url_filter.MODEL_WORDS + 2000
    urls = [f"x://{w}.net/" for w in words] + [f"x://casino.net/{w}" for w in words[-30:]] + ["x://a.com/de/zebra", None, f"x://{words[-1]}.net/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "rid long, url string").repartition(4)
    made = url_filter.judge(pages).orderBy("rid").collect()
    want = bayes_odds([(r["words"], r["rule_verdict"]) for r in made])
    assert [r["rid"] for r in made] == list(range(len(urls))) and all(abs(r["block_odds"] - x) < 1e-9 for r, x in zip(made, want))
    few = pages.where(f"rid >= {len(words) - 100}")
    key = ("rid", "words", "block_odds", "verdict")
    assert url_filter.judge(few, held_words=2).select(*key).orderBy("rid").collect() == url_filter.judge(few).select(*key).orderBy("rid").collect()


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = list(zip(words, words[1:], words[2:]))
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


def quality_texts():
    r = random.Random(8)
    rows = [" ".join(r.choice(["alpha", "beta", "gamma", "é", "#x", "日本"]) + r.choice(["", "\n", "\x0b", "\x85"]) for _ in range(r.randint(0, 90))) for _ in range(40)]
    return [None, "", " \n ", "a b c a b c", "x" * 5000, "a\n a\na\n\n\n", "a b a b a b", *rows]


def test_quality_base_rules(spark):
    texts = quality_texts()
    docs = spark.createDataFrame([(i, t, None if i % 3 else "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    made = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    for i, text in enumerate(texts):
        r, want = made[i], base_counts(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["kept"] and r["base_failed"])
    assert quality_rules.judge(docs.limit(0)).count() == 0


def test_words_measured_one_by_one():
    own = quality_rules.Meter(public_tokenizers.path(quality_rules.PIECES), public_tokenizers.path(quality_rules.RANKS))
    words = "plain words and \U0001F9FF a a a".encode().split()
    own.learn(set(words))
    per_token, per_byte_token, fallback, entropy = own.measure(words, 20)
    ids = [i for w in words for i in own.pieces.encode(w.decode())]
    assert per_token == 20 / len(ids) and fallback == sum(map(own.pieces.is_byte, ids)) / len(ids) > 0
    assert 0 < entropy < 1 and per_byte_token > 0
    assert own.measure([], 0) == (0.0, 0.0, 0.0, 1.0)


def test_bands_reject_odd_tokens_and_keep_prose(spark):
    r = random.Random(1)
    words = "the house stands near a river and people walk along it every day with their dogs".split()
    prose = [" ".join(r.choice(words) + str(r.randint(0, 9)) * (r.random() < 0.1) for _ in range(150)) for _ in range(60)]
    odd = " ".join("".join(chr(r.randint(0x1F300, 0x1F5FF)) for _ in range(3)) for _ in range(80))
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate([*prose, odd])], "doc_id long, text string, lang string")
    kept = {x["doc_id"]: x["kept"] for x in quality_rules.judge(docs).where("NOT base_failed").collect()}
    assert not kept[60] and all(v for k, v in kept.items() if k < 60)


LICENCES = [
    None, "", "MIT License", "the mit\nlicense; MIT-License, apache license mit", "Licensed under the Apache License, Version 2.0.", "licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.", "general public licensee", "mit é license", "É MIT license\x00general public license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "apache\u2028license", "K license mit",
]


def base_licence(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = sorted((i, label) for p, label in license_scan.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
    return len(words), places


def test_license_places_and_labels(spark):
    rows = [(i % 7 or None, t, 1) for i, t in enumerate(LICENCES)] + [(1, "plain words here", 2)] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string, words int")
    made = license_scan.scan(docs.select("doc_id", "text")).collect()
    got = sorted(str((r["doc_id"], r["n_words"], [tuple(p) for p in r["places"]])) for r in made)
    assert got == sorted(str((d, *base_licence(t))) for d, t, _ in rows)
    labels = [m["label"] for r in made for m in r["matches"]]
    assert {"mit", "apache", "gpl", "cc-by-nc"} <= set(labels)
    assert all(0 < m["share"] <= 1 for r in made for m in r["matches"])
    assert license_scan.scan(docs.limit(0).select("doc_id", "text")).count() == 0


def test_license_query_runs_no_python(spark):
    plan = catalog.op7_license_scan(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|ExternalRDD", plan)


def test_license_moved_words_do_not_match(spark):
    docs = spark.createDataFrame([(1, "version 2 0 of something that is licensed apache under the license")] + [(2, "other words")] * 50, "doc_id long, text string")
    assert all(not r["matches"] for r in license_scan.scan(docs).collect())


def licence_shares(text, idf):
    """Best aligned share of each template in a text whose key phrases it has, counted one by one."""
    words, out = base_words(text), {}
    for k, (_, phrases, notice) in enumerate(license_scan.TEMPLATES):
        own = notice.split()
        if all(f" {p} " in f" {' '.join(words)} " for p in phrases):
            best = max(sum(idf[w] for j, w in enumerate(own) if 0 <= i + j < len(words) and words[i + j] == w) for i in range(-len(own), len(words)))
            out[k] = best / sum(idf.get(w, 0.0) for w in own)
    return {k: v for k, v in out.items() if v >= license_scan.MIN_SHARE}


def base_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_license_many_notices_in_one_file(spark):
    notices = [n for _, _, n in license_scan.TEMPLATES]
    mit, lgpl, bsd, isc = notices[1], notices[5], notices[7], notices[12]
    texts = [*notices, ". ".join([bsd, mit]), ". ".join([bsd, isc]), ". ".join([bsd, mit, lgpl]), ". and then\n".join(notices), mit[:70] + " x " + mit[70:]] + ["plain words of the text"] * 60
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    indexed = license_scan.index_words(docs)
    seen = [set(base_words(t)) for t in texts]
    idf = {w: math.log1p(len(texts) / sum(w in s for s in seen)) for w in license_scan.vocabulary() if any(w in s for s in seen)}
    ids = {r["rid"]: r["doc_id"] for r in indexed.select("rid", "doc_id").collect()}
    got = {(ids[r["rid"]], r["template"]): r["share"] for r in license_scan.template_matches(indexed).collect()}
    want = {(i, k): v for i, t in enumerate(texts) for k, v in licence_shares(t, idf).items()}
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-9 for x in want)
    everything = len(notices) + 3
    assert all(got[everything, k] > 0.999 for k in range(len(notices)))


def base_secrets(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[1]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def secret_texts():
    r = random.Random(6)
    hexes = ["".join(r.choice("0123456789abcdef") for _ in range(40)) for _ in range(40)]
    keys = ["AKIA" + "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(16)) for _ in range(30)]
    odd = [None, "", "password=secret:abcdefghijklmnop", "tokeN = 'abcdef.ghijkl'", "\u017fecret=abcdefghijklmnop", "to\u212aen=abcdefghijklmnop", "AKIAAKIA12 AKIA" + "A" * 13, "é" * 9 + "token=" + hexes[0], "passwd:\nabcdefghijklmn", "api_key==aaaaaaaaaaaa"]
    return odd + [f"some ordinary words token = \"{h}\" thereafter" for h in hexes] + [f"id {k} and {h}" for k, h in zip(keys, hexes)]


def test_secret_base_spans(spark):
    rows = [(i % 50, t) for i, t in enumerate(secret_texts())] + [(None, "token=" + "a1" * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = secret_scan.scan(docs).collect()
    got = sorted(str((r["doc_id"], ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in r["spans"] if s["base"]))) for r in made)
    assert got == sorted(str((d, base_secrets(t or ""))) for d, t in rows)
    assert secret_scan.scan(docs.limit(0)).count() == 0
    nothing = secret_scan.scan(spark.createDataFrame([(1, "no secrets in here")], "doc_id long, text string")).first()
    assert nothing["spans"] == []


def test_method_finds_credentials_of_a_learnt_format(spark):
    r = random.Random(3)
    unlabelled = "ASIA" + "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(16))
    rows = [(i, t) for i, t in enumerate(secret_texts())] + [(900, f"see {unlabelled} now"), (901, "internationalisation-of-documentation-2024 or thiswordislongandplain1")]
    made = {x["doc_id"]: x["spans"] for x in secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [s["kind"] for s in made[900]] == ["format"] and made[901] == []


def test_merging_keeps_the_language_and_shrinks_the_tree():
    r = random.Random(2)
    words = ["".join(r.choice("dh") for _ in range(r.randint(10, 30))) for _ in range(200)]
    made = secret_scan.Automaton(words)
    assert len(made.next) < 0.05 * sum(map(len, words))
    assert made.rate("dhdhhhddhdhd") > made.rate("LLLLLLLLLLLL")
    assert secret_scan.Automaton([]).rate("d") < 0


def test_long_tokens_are_rated_to_their_end(spark):
    r = random.Random(4)
    signs = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    head = "ASIA" + "".join(r.choice(signs) for _ in range(380))
    tail = "".join(r.choice(signs) for _ in range(4000))
    plain = "/" + "ordinary/words/" * 300
    rows = [(i, t) for i, t in enumerate(secret_texts())] + [(900, f"see {head}{tail} now"), (901, f"see {head}{plain} now"), (902, f"see {head} now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = {x["doc_id"]: [s for s in x["spans"] if not s["base"]] for x in secret_scan.scan(docs).collect()}
    assert [(s["start"], s["end"]) for s in made[900]] == [(4, 4 + len(head + tail))] and len(made[902]) == 1 and made[901] == []
    own = secret_scan.Formats(secret_scan.sample(docs))

    def slow(automaton, word):
        at, bits = 0, 0.0
        for c in [*word, ""]:
            seen = automaton.count[at] if at is not None else {}
            bits += math.log2((seen.get(c, 0) + 0.05) / (sum(seen.values()) + 0.05 * 12))
            at = automaton.next[at].get(c) if at is not None else None
        return bits / (len(word) + 1)

    for value in (head + tail, head + plain, head, "deadbeef" * 700, "", "x" * 900 + "!"):
        for automaton in (own.plain, *own.formats.values()):
            assert abs(automaton.rate(secret_scan.symbols(value)) - slow(automaton, secret_scan.symbols(value))) < 1e-9
        kind, ahead = own.likelihood(value)
        assert kind is None or abs(ahead - (slow(own.formats[kind], secret_scan.symbols(value)) - slow(own.plain, secret_scan.symbols(value)))) < 1e-9


def test_short_and_letter_only_credentials_are_scored(spark):
    r = random.Random(9)
    made = ["".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(13)) for _ in range(60)]
    mixed = ["".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(13)) for _ in range(60)]
    ordinary = "internationalisation documentation-of-things acknowledgement notwithstanding characteristics responsibilities"
    texts = [f"token={x} and {ordinary}" for x in made + mixed]
    hidden = ["QJXWVKZPRTBMG", "Q7XWV2ZP9TBMG"]
    docs = spark.createDataFrame(list(enumerate([*texts, *(f"see {x} now" for x in hidden), f"{ordinary} token={made[0]}/tail"])), "doc_id long, text string")
    spans = {x["doc_id"]: x["spans"] for x in secret_scan.scan(docs).collect()}
    for k, x in enumerate(hidden):
        assert [(s["kind"], s["start"], s["end"]) for s in spans[len(texts) + k]] == [("format", 4, 4 + len(x))]
    assert all(s["base"] for k in [*range(len(texts)), len(texts) + 2] for s in spans[k])
    assert len(spans[len(texts) + 2]) == 1


def planted_formats(r, n):
    """Credentials of formats with separators and lengths of their own."""
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

    def some(signs, k):
        return "".join(r.choice(signs) for _ in range(k))

    makers = [
        lambda: f"sk_live_{some(alnum, 24)}",
        lambda: "-".join(some("0123456789ABCDEF", k) for k in (8, 4, 4, 4, 12)),
        lambda: some(alnum + "+/", 43) + "=",
        lambda: f"{some('0123456789', 6)}-{some('abcdefghijklmnopqrstuvwxyz0123456789', 32)}",
    ]
    return [makers[k % len(makers)]() for k in range(n)]


def test_stripped_credentials_are_found(spark):
    """Held-out credentials without their labels among whole test documents: recall and false spans."""
    r = random.Random(12)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labelled = [(10_000 + i, f"words before token = \"{v}\" and after") for i, v in enumerate(planted_formats(r, 160))]
    hidden = planted_formats(r, 200)
    bare = [(20_000 + i, f"words before {v} and after") for i, v in enumerate(hidden)]
    made = secret_scan.scan(docs.unionByName(spark.createDataFrame(labelled + bare, "doc_id long, text string")))
    spans = [(x["doc_id"], s) for x in made.collect() for s in x["spans"]]
    hits = {(d, s["start"], s["end"]) for d, s in spans if not s["base"]}
    wanted = {(20_000 + i, 13, 13 + len(v)) for i, v in enumerate(hidden)}
    assert len(wanted & hits) >= 0.9 * len(wanted)
    assert len([h for h in hits if h[0] < 10_000]) <= 2
    assert all(s["likelihood"] is not None for _, s in spans)


def test_structure_survives_the_merges():
    r = random.Random(1)
    words = [secret_scan.symbols(v) for v in planted_formats(r, 120)]
    made = secret_scan.Automaton(words)
    fresh = [secret_scan.symbols(v) for v in planted_formats(r, 40)]
    moved = [w.replace("-", "d").replace("_", "l") for w in fresh if "-" in w or "_" in w]
    assert sum(map(made.fits, fresh)) >= 32
    assert sum(made.fits(w[:-5]) for w in fresh) <= len(fresh) // 2  # five signs short
    assert sum(made.rate(w) for w in moved) / len(moved) < sum(made.rate(w) for w in fresh) / len(fresh)


def test_no_value_is_written_by_the_secret_scan(spark):
    import os

    from castwright.session import ensure_checkpoint_dir

    value = "sk_live_Zq7Xw0Vt5Rk3Mn8Jp2Ld"
    docs = spark.createDataFrame([(i, f'token = "{value}{i:04d}"') for i in range(20)], "doc_id long, text string")
    secret_scan.sample(docs)
    root = ensure_checkpoint_dir(spark).removeprefix("file://")
    held = [os.path.join(d, f) for d, _, files in os.walk(root) if "credential" in d for f in files if f.endswith(".parquet")]
    assert held and not any(value.encode() in open(f, "rb").read() for f in held)
