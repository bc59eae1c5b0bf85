"""Quality rules, licences, personal data and secrets against brute force."""

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction
from math import comb

import numpy as np
import pytest

from accesslake.llm import licenses, pieces, pii, quality, secrets, token_counts
from accesslake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def brute_quality(t):
    words = SPACED.findall(t or "")
    lines = [x for x in (t or "").split("\n") if SPACED.search(x)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    repeated = len({p + k for v in windows.values() if len(v) > 1 for p in v for k in range(8)})
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), repeated


def test_quality_base_equals_brute_force(spark, docs, odd):
    rows = QUERIES["op2_quality_rules"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, *rest = brute_quality(docs[r.doc_id].text)
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == [n, *rest]
        assert r.base_failed == (n < 20 or 100 * r.n_repeat_words > 30 * n) and not (r.base_failed and r.kept)


def test_repeated_words_on_random_texts():
    rnd = random.Random(2)
    for _ in range(300):
        words = [rnd.choice("ab") for _ in range(rnd.randint(0, 60))]
        assert quality.repeated_words(words) == brute_quality(" ".join(words))[4]


def test_binomial_tail_is_exact():
    for k, n, p in ((0, 10, Fraction(1, 100)), (3, 50, Fraction(1, 20)), (7, 7, Fraction(1, 2)), (40, 900, Fraction(1, 25))):
        exact = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert quality.binomial_tail(k, n, float(p)) == pytest.approx(float(exact), rel=1e-9)
    assert quality.binomial_tail(0, 0, 0.1) == 1.0


def test_cutoffs_hold_their_risk():
    """Over many drawn label sets, cutoffs whose true risk is too high are accepted at most delta of the time."""
    rnd, broken, risk, level = random.Random(4), 0, 0.05, 0.1
    for _ in range(400):
        draw = lambda n, lo: Counter(min(39, int(40 * rnd.random() ** lo)) for _ in range(n))
        table = lambda c: [c[i] for i in range(40)]
        cutoff = quality.choose_cutoff(table(draw(100, 1)), table(draw(20_000, 1)), table(draw(150, 1)), level, risk)
        broken += cutoff is not None and 1 - cutoff > risk + 1e-9
    assert broken <= 400 * level * 1.5
    assert quality.choose_cutoff([0] * 40, [0] * 39 + [9], [0] * 40, 0.01, 0.01) is None


def test_quality_rejects_bad_and_keeps_good(spark):
    """On the given tables: next to no good document is lost, and bad ones of the three larger languages are rejected."""
    path = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op2_quality_rules"](spark, path).filter("not base_failed").collect()
    good = [r.kept for r in rows if labels.get(r.doc_id) == 1]
    assert sum(good) >= 0.98 * len(good)
    for lang in ("en", "de", "fr"):
        bad = [r.kept for r in rows if labels.get(r.doc_id) == 0 and langs[r.doc_id] == lang]
        assert len(bad) > 20 and sum(bad) <= 0.1 * len(bad), lang


def test_copies_of_a_text_are_one_label(spark):
    metrics = spark.createDataFrame([(i, "en", i // 3, 0, *[0.0] * 8) for i in range(9)], "doc_id long, stratum string, k1 long, k2 long, " + ", ".join(f"{r} double" for r in quality.RULES))
    labels = spark.createDataFrame([(i, int(i != 4)) for i in range(9)], "doc_id long, quality int")
    rows = quality.label_metrics(metrics, labels).collect()
    assert sorted((r.half, r.good) for r in rows) == [(False, True), (False, True), (True, False)]


def test_cutoffs_reject_bad_documents_of_every_language(spark):
    """Several hundred good labels a language are enough for cutoffs, and few good documents are lost to all rules together."""
    good, bad = (0.0,) * 8, (0.0, 0.0, 0.0, 0.6, 0.5, 0.0, 0.0, 0.0)
    rows = [(lang, i % 6 > 0, i // 6 % 2 == 1, *(good if i % 6 or i % 5 == 0 else bad)) for lang in ("en", "de", "fr", None) for i in range(600)]
    schema = "stratum string, good boolean, half boolean, " + ", ".join(f"{r} double" for r in quality.RULES)
    found = {r.stratum: r.cutoffs for r in quality.fit_cutoffs(spark.createDataFrame(rows, schema)).collect()}
    assert set(found) == {"en", "de", "fr", None}
    for cutoffs in found.values():
        assert any(x >= c for x, c in zip(bad, cutoffs)) and not any(x >= c for x, c in zip(good, cutoffs))


def test_rules_are_tested_jointly(spark):
    """Rules that each lose 1.5 % of the good documents of the tested half, not the same ones, are not accepted together."""
    metrics = lambda rule: tuple(0.5 if i == rule else 0.0 for i in range(8))
    rows = [("en", False, False, *metrics(i % 4)) for i in range(400)] + [("en", True, False, *metrics(9))] * 1000
    rows += [("en", True, True, *metrics(i // 45 if i < 180 else 9)) for i in range(3000)]
    schema = "stratum string, good boolean, half boolean, " + ", ".join(f"{r} double" for r in quality.RULES)
    cutoffs = quality.fit_cutoffs(spark.createDataFrame(rows, schema)).first().cutoffs
    assert sum(c < 1 for c in cutoffs) <= 1


def test_quality_odd_rows(spark, odd, none, odd_rows):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (4, None), (99, 1)], "doc_id long, quality int")
    rows = quality.quality_verdicts(odd, labels).collect()
    assert len(rows) == len(odd_rows)
    kept = quality.keep_good(odd, labels)
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in rows)
    assert quality.quality_verdicts(none, labels).count() == quality.keep_good(none, labels).count() == 0
    assert quality.quality_verdicts(odd, labels.limit(0)).count() == len(odd_rows)


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def brute_licences(texts):
    """Everything from the definition, with loops."""
    words = [ALNUM.findall((t or "").translate(LOWER)) for t in texts]
    postings = licenses.template_postings()
    vocabulary = {w for w, _, _ in postings}
    df = Counter(w for x in words for w in vocabulary & set(x))
    out = []
    for x in words:
        places, base = [], set()
        for p, label in PHRASES.items():
            q = p.split()
            at = [i for i in range(len(x) - len(q) + 1) if x[i : i + len(q)] == q]
            places += at
            base |= {label} if at else set()
        rare = sorted(vocabulary & set(x), key=lambda w: (df[w], w))[: licenses.RARE]
        votes = {}
        for i, w in enumerate(x):
            if w in rare:
                for pw, name, at in postings:
                    if pw == w:
                        votes.setdefault((name, i - at), set()).add(w)
        joined, added, share = f" {' '.join(x)} ", set(), 0.0
        for (name, _), v in votes.items():
            if len(v) >= licenses.MIN_VOTES and all(f" {p} " in joined for p in licenses.TEMPLATES[name][1]):
                added.add(name)
                share = max(share, min(1.0, len(v) / licenses.template_sizes()[name]))
        ends = (min(places), max(places)) if places else (None, None)
        out.append((len(x), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(base | added)), 1.0 if base else share))
    return out


def test_licences_equal_brute_force(spark, docs, odd, none):
    ids = sorted(docs)
    want = dict(zip(ids, brute_licences([docs[i].text for i in ids])))
    rows = QUERIES["op3_license_scans"](spark, SF).collect()
    assert {r.doc_id: tuple(r)[1:7] for r in rows} == {i: w[:6] for i, w in want.items()}
    assert all(r.score == pytest.approx(want[r.doc_id][6]) for r in rows)
    assert any("gpl-3.0" in r.labels for r in rows)
    found = licenses.licence_labels(odd).collect()
    assert Counter((r.n_words, r.n_base) for r in found) == Counter(w[:2] for w in brute_licences([r.text for r in odd.collect()]))
    assert licenses.licence_labels(none).count() == 0


def test_licence_templates(texts):
    full = [t for t, _ in licenses.TEMPLATES.values()]
    rows = licenses.licence_labels(texts(*full, "cc by cc by cc", "CC-BY, Mit License")).orderBy("doc_id").collect()
    for r, name in zip(rows, licenses.TEMPLATES):
        assert name in r.labels
    assert rows[-2].n_base == 2 and (rows[-2].first_word, rows[-2].last_word) == (0, 2)
    assert rows[-1].base_labels == ["cc-by", "mit"]


def test_licences_of_one_file_do_not_crowd_each_other_out(texts):
    """Two and three licences in a file, beside a hot notice that a third of the rows carry, and prose of rarer words."""
    full = {n: t for n, (t, _) in licenses.TEMPLATES.items()}
    hot, prose = full["cc-by-nc-4.0"], "permission copyright library contributors source binary redistribution forms modification hereby granted software charge"
    many = [f"{full['bsd']} {hot}", f"{full['bsd']} {full['isc']} {hot}", f"{full['mpl-2.0']} then {full['mit-text']} then {full['unlicense']}", f"{prose} {hot}"]
    rows = licenses.licence_labels(texts(*many, *[f"{hot} {i}" for i in range(20)], *["plain words here"] * 30)).orderBy("doc_id").collect()
    for r, wanted in zip(rows, ({"bsd", "cc-by-nc-4.0"}, {"bsd", "isc", "cc-by-nc-4.0"}, {"mpl-2.0", "mit-text", "unlicense"}, {"cc-by-nc-4.0"})):
        assert wanted <= set(r.labels)


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_pii(t):
    out = []
    for kind, p in PII.items():
        for m in re.finditer(p, t):
            d = [c for c in m.group() if c.isdigit()]
            fits = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 13 <= len(d) <= 19 and pii.luhn("".join(d)), "phone": 9 <= len(d) <= 15}
            if fits[kind]:
                out.append((kind, *m.span()))
    return out


SECRETS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile("AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+"),
}


def brute_secrets(t):
    least = {"assign": 6, "access": 20, "hex": 24}
    spans = [(k, *m.span()) for k, p in SECRETS.items() for m in p.finditer(t) if len(m.group(2) if k == "assign" else m.group()) >= least[k]]
    return sorted(spans, key=lambda x: (x[1], list(SECRETS).index(x[0])))


def test_base_spans_on_random_texts():
    rnd = random.Random(3)
    parts = ["a", "@", ".", "1", "2", "55", "-", " ", "+", "(", ")", "é", "256", "\n", "4111111111111111", "password", "=", ":", "'", "secret", "Api_Key", "AKIA", "deadbeef0123", "K", "x@y.z"]
    for _ in range(8000):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30)))
        assert pii.base_spans(t) == brute_pii(t)
        assert secrets.base_spans(t) == brute_secrets(t)
    pii.base_spans("1" * 50_000 + "." + "a" * 50_000 + "@" * 1000), secrets.base_spans("f" * 100_000)


def listed(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def test_scan_queries_equal_brute_force(spark, docs):
    for r in QUERIES["op5_pii"](spark, SF).collect():
        base = brute_pii(docs[r.doc_id].text)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, _, _ in base) for k in PII]
        assert r.base_sha256 == sha(listed(base)) and r.spans.startswith(listed(base))
    for r in QUERIES["op6_secret_scans"](spark, SF).collect():
        base = brute_secrets(docs[r.doc_id].text)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for x, _, _ in base) for k in SECRETS]
        assert r.base_sha256 == sha(listed(base)) and set(listed(base).split(",")) - {""} <= set(r.spans.split(","))


def test_weak_supervision_finds_and_leaves(texts):
    body = ["call (375) 555-4393 now", "Contact Mr. John Smith today", "bank DE89 3704 0044 0532 0130 00 end", "SSN 078-05-1120", "version 000-12-3456 12345678", "bank ZZ11 3704 0044 0532 0130 00"]
    rows = pii.find_personal_data(texts(*body * 5)).select("doc_id", "found.*").collect()
    kinds = {r.doc_id: {x.split(":")[0] for x in r.spans.split(",") if x} for r in rows}
    assert kinds[0] == {"national_phone"} and "iban" in kinds[2] and "ssn" in kinds[3]
    assert not kinds[4] and not kinds[5]


def test_reliabilities_are_recovered():
    """Votes drawn from labelers of known reliability: EM ranks them rightly and labels nearly all candidates."""
    rnd, true, patterns, kinds = random.Random(1), (0.95, 0.9, 0.8, 0.75, 0.7), Counter(), {}
    for _ in range(20_000):
        truth = rnd.random() < 0.4
        v = "".join("01"[truth == (rnd.random() < a)] if rnd.random() < 0.8 else "-" for a in true)
        patterns["ssn:" + v] += 1
        kinds.setdefault("ssn:" + v, Counter())[truth] += 1
    post, right = pii.estimate(patterns)
    assert all(abs(right[t][i] - a) < 0.05 for t in (0, 1) for i, a in enumerate(true))
    agree = sum(n for k, c in kinds.items() for t, n in c.items() if (post[k] > 0.5) == t)
    assert agree > 0.93 * 20_000


def test_network_on_held_out_findings(spark):
    """Trained on one set of documents, it tells secrets from prose in another."""
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice(("tion", "ing", "the", "er", "ment", "ous")) for _ in range(rnd.randint(4, 7)))
    key = lambda: "".join(rnd.choice("0123456789abcdef") for _ in range(40))
    prose = lambda: f"of the {word()}{word()} and {word()}{word()}x in a"
    leak = lambda: f'the token = "{key()}" of'
    rows = [(i, leak() if i % 2 else prose()) for i in range(400)]
    network = secrets.train(spark.createDataFrame(rows, "doc_id long, text string"))
    views = lambda t: [secrets.view(t, *m.span()) for m in secrets.RUN.finditer(t)]
    import numpy as np

    yes = network.probability(np.stack([v for _ in range(100) for v in views(leak())])) >= network.threshold
    no = network.probability(np.stack([v for _ in range(100) for v in views(prose())])) >= network.threshold
    assert yes.mean() >= 0.95 and no.mean() <= 0.05


def test_redaction_and_odd_rows(odd, none, odd_rows):
    assert secrets.redact("a password=abcdef b", [("assign", 2, 17), ("hex", 11, 17)], "*") == "a * b"
    for frame in (pii.find_personal_data(odd), secrets.find_secrets(odd)):
        assert frame.count() == len(odd_rows)
    texts = [r.x for r in odd.select(secrets.redacted(odd.text, None).alias("x")).collect()]
    assert sorted(map(str, texts)) == sorted(str(r[1]) for r in odd_rows)
    assert pii.find_personal_data(none).count() == secrets.find_secrets(none).count() == 0


def test_the_whole_of_a_candidate_is_read():
    """Windows see every character of a long run and what follows; a key late in it is marked, and short strings after a cue."""
    seen = lambda v: "".join(chr(c % 99 + 32) for c in v if c % 99 < 95)

    class Finds(secrets.Network):
        def probability(self, x):
            return np.array([float("Zq9" in seen(v)) for v in x])

    import numpy as np

    network = Finds()
    network.threshold = 0.5
    path = "static/" * 30
    late, short = f"see {path}aZq9aaaabbbb/end of", "pwd: xZq9abc done"
    (_, found), (_, cued), (_, none) = secrets.all_spans([late, short, "see " + path], network)
    at = late.index("aZq9")
    assert len(found) == 1 and found[0][1] <= at and found[0][2] >= at + 12 and found[0][2] - found[0][1] < 120
    assert cued == [("network", 5, 12)] and none == []
    assert secrets.outside(0, 50, [("hex", 10, 40), ("hex", 38, 46)]) == [(0, 10)] and secrets.outside(3, 5, []) == [(3, 5)]
    v = secrets.view("ab " + "k" * 16 + " cd", 3, 19)
    assert (v >= secrets.INSIDE).sum() == 16


def test_columns_of_the_results_name_stay(texts):
    for run, name in (
        (secrets.find_secrets, "found"), (pii.find_personal_data, "found"), (token_counts.count_tokens, "counted"), (pieces.encode_documents, "encoded"),
    ):
        rows = texts("one two").selectExpr("*", f"'kept' as {name}")
        got = run(rows)
        assert got.columns == [*rows.columns, f"{name}_"]
        first = got.first()
        assert first[name] == "kept" and first[f"{name}_"] is not None
    ids = texts("x").selectExpr("array(5, 6) as ids", "'kept' as decoded")
    assert pieces.decode_documents(ids).first()["decoded"] == "kept"


class AllSecret(secrets.Network):
    def __init__(self):
        super().__init__()
        self.threshold = 0.5

    def probability(self, x):
        return np.ones(len(x))


def test_what_base_spans_leave_is_judged_whatever_the_length():
    """The same flanks of a hex run, in a candidate below and beyond one window."""
    hex_run = "0123456789abcdef01234567"
    for flank in ("Zk" * 9, "Zk" * 30):
        text = f"see {flank}/{hex_run}/{flank} end"
        ((base, spans),) = secrets.all_spans([text], AllSecret())
        added = [(s, e) for k, s, e in spans if k == secrets.ADDED]
        assert len(base) == 1 and len(added) == 2
        assert all(flank in text[s:e] or text[s:e] in text for s, e in added)
    ((_, spans),) = secrets.all_spans([f"id={hex_run} {hex_run}"], AllSecret())
    assert [k for k, _, _ in spans] == ["hex", "hex"]


def test_rows_say_whether_a_network_was_trained(texts):
    assert [r.found.trained for r in secrets.find_secrets(texts("nothing here")).collect()] == [False]


def test_threshold_is_the_recall_alone():
    network = secrets.Network()
    network.raw = lambda x: x[:, 0].astype(float)
    x = np.concatenate([np.linspace(-3, 3, 200), np.linspace(-6, 6, 2000)])[:, None]
    y = np.array([1.0] * 200 + [0.0] * 2000)
    network.calibrate(x, y, 0.98)
    assert network.threshold < 0.5 and (network.probability(x[:200]) >= network.threshold).mean() >= 0.98


def leaks_and_prose(n, seed=9):
    """Texts of which every fourth leaks a key that no other text has."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice(("tion", "ing", "the", "er", "ment", "ous")) for _ in range(rnd.randint(4, 7)))
    key = lambda: "".join(rnd.choice("0123456789abcdef") for _ in range(40))
    return [f'the token = "{key()}" of' if i % 4 == 0 else f"of the {word()}{word()} and a" for i in range(n)]


def test_the_network_learns_from_all_findings(texts, monkeypatch):
    """More findings than a block has: each is in a block or in the calibration, and a rare kind is in every block."""
    monkeypatch.setattr(secrets, "BLOCK", 300)
    monkeypatch.setattr(secrets, "FEWEST", 60)
    learnt, scored = [], []
    fit, calibrate = secrets.fit, secrets.calibrate
    monkeypatch.setattr(secrets, "fit", lambda n, found, *x: (learnt.extend(found.collect()), fit(n, found, *x)))
    monkeypatch.setattr(secrets, "calibrate", lambda n, found, *x: (scored.extend(found.collect()), calibrate(n, found, *x)))
    docs = texts(*leaks_and_prose(4000))
    network = secrets.train(docs)
    every = {(r.secret, r["view"]) for r in secrets.finding_views(docs, "doc_id", "text").collect()}
    assert len(every) > 4000 and sum(s for s, _ in every) > 900
    assert {(r.secret, r["view"]) for r in learnt} | {(r.secret, r["view"]) for r in scored} == every
    assert len(learnt) + len(scored) == len(every)
    fresh = leaks_and_prose(400, seed=10)
    sure = [len(spans) > len(base) for base, spans in secrets.all_spans([t.replace("token", "see") for t in fresh if "token" not in t], network)]
    views = np.stack([secrets.view(t, *m.span()) for t in fresh if "token" in t for m in secrets.RUN.finditer(t)])
    assert np.mean(sure) <= 0.05 and (network.probability(views) >= network.threshold).mean() >= 0.95


def test_blocks_hold_every_finding(texts, monkeypatch):
    monkeypatch.setattr(secrets, "BLOCK", 300)
    monkeypatch.setattr(secrets, "FEWEST", 60)
    docs = texts(*[t for i, t in enumerate(leaks_and_prose(4000)) if i % 4 or i % 80 == 0])
    found = secrets.finding_views(docs, "doc_id", "text").distinct()
    numbers = {r.secret: r["count"] for r in found.groupBy("secret").count().collect()}
    packed, of_secret, of_other = secrets.blocks_of(found, numbers[True], numbers[False])
    rows = [(other, v) for r in packed.collect() for other, v in zip(r.other, r["view"])]
    assert of_other == 1 and of_secret > 1 and packed.count() > 5
    assert len(set(rows)) == sum(numbers.values()) and sum(not o for o, _ in rows) == numbers[True] * of_secret
    assert min(sum(not o for o in r.other) for r in packed.collect()) >= 20


def test_calibration_in_spark_is_that_of_the_rows(spark):
    """The same slope, offset and threshold from tables as from arrays, also where the kinds are far apart."""

    class Graded(secrets.Network):
        def raw(self, x):
            return x[:, 0].astype(float) - 60

    rnd = np.random.default_rng(5)
    for far in (1.0, 40.0):
        codes = np.clip(rnd.normal(60, 8, 400) + np.repeat([far / 2, -far / 2], 200), 0, 95).astype(np.uint8)
        x, y = np.repeat(codes[:, None], secrets.WINDOW, axis=1), np.repeat([1.0, 0.0], 200)
        both = [Graded(), Graded()]
        both[0].calibrate(x.astype(np.int64), y, 0.98)
        rows = spark.createDataFrame([(bool(s), bytes(v)) for s, v in zip(y, x)], "secret boolean, view binary")
        secrets.calibrate(both[1], rows, 200, 200, 0.98)
        for name in ("slope", "offset", "threshold"):
            assert abs(getattr(both[0], name) - getattr(both[1], name)) < 1e-6 * max(1, abs(getattr(both[0], name)))
        assert 0 < both[0].slope < 20 and (both[0].probability(x[:200]) >= both[0].threshold).mean() >= 0.98


def test_values_by_their_place(spark):
    values = [float(i * 7 % 500) for i in range(500)] + [3.0] * 20
    frame = spark.createDataFrame([(v,) for v in values], "z double").repartition(7)
    assert [secrets.value_at(frame, i) for i in (0, 3, 22, 23, 519)] == [sorted(values)[i] for i in (0, 3, 22, 23, 519)]
