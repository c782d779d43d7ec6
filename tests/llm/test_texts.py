"""Rules, licences, templates, lengths and packing against plain Python."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tideline.llm import lengths, licenses, packing, rules, templates

PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def base_counts(text):
    words = (text or "").encode().split()
    n = len(words)
    grams = Counter(tuple(words[i : i + 8]) for i in range(n - 7))
    covered = {
        p for i in range(n - 7) if grams[tuple(words[i : i + 8])] > 1 for p in range(i, i + 8)
    }
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (
        n,
        sum(len(w.decode()) for w in words),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_rule_counts(make, odd, prose):
    texts, ids = odd
    line = prose(3, 30)
    texts = [*texts, f"{line}\n{line}\n#$%\n{line}", "a b c d e f g h " * 6, "a b " * 40]
    ids = [*ids, 20, 21, 22]
    rows = rules.judged(make(texts, ids)).collect()
    expected = []
    for i, t in zip(ids, texts, strict=True):
        c = base_counts(t)
        expected.append((i, *c, c[0] < 20 or 100 * c[4] > 30 * c[0]))
    got = [(r.doc_id, *(r[c] for c in rules.BASE), r.base_failed) for r in rows]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert not any(r.kept for r in rows if r.base_failed)


def test_thresholds_follow_the_group(make, prose):
    """A source of symbols keeps its usual documents; the same text is junk elsewhere."""
    code = [prose(i, 60).replace(" ", " # ") for i in range(60)]
    plain = [prose(100 + i, 60) for i in range(60)]
    df = make(
        [*code, *plain, code[0]], sources=["code"] * 60 + ["web"] * 60 + ["web"],
        langs=[None] * 60 + ["en"] * 61,
    )
    kept = {r.doc_id: r.kept for r in rules.judged(df).collect()}
    assert all(kept[i] for i in range(120))
    assert not kept[120]
    left = rules.kept(df)
    assert left.columns == df.columns and left.count() == 120


def test_rules_on_empty_table(make):
    assert rules.judged(make([])).count() == 0
    assert rules.kept(make([])).count() == 0


def test_licences(make, odd):
    texts, ids = odd
    notice = (
        "Some code.\nLicensed under the Apache License, Version 2.0 (the \"License\").\n"
        "you may not use this file except in compliance with the License.\n"
        "You may obtain a copy of the License at\n http://www.apache.org/licenses/LICENSE-2.0"
    )
    two = "Released under the MIT License.\nx\nLicensed under CC BY 4.0.\nReleased under the MIT License."
    df = make([*texts, notice, two, two], [*ids, 30, 31, 31])
    got = sorted(map(tuple, licenses.scan(df).collect()))
    assert got == [
        (30, "apache-notice", "Apache-2.0", 1, 4, 2, 4),
        (31, "cc-by-line", "CC-BY-4.0", 1, 1, 3, 3),
        (31, "cc-by-line", "CC-BY-4.0", 1, 1, 3, 3),
        (31, "mit-line", "MIT", 2, 2, 1, 3),
        (31, "mit-line", "MIT", 2, 2, 1, 3),
    ]
    assert licenses.scan(make([])).count() == 0


def test_leaks(spark, make, odd, prose):
    items = [prose(50, 30), prose(51, 16),
             "Last week Anna sold 12 apples to Peter and then Anna bought 7 km of rope from Peter for 3 dollars"]
    bench = spark.createDataFrame(
        [*enumerate(items), (3, None), (4, ""), (5, items[1])], "item_id long, text string"
    )
    texts, ids = odd
    other = items[2].replace("Anna", "Maria").replace("Peter", "Juan").replace("12", "40")
    mixed = items[2].replace("then Anna", "then Maria")
    docs = [
        f"{prose(60, 200)} {items[0]} {prose(61, 100)}",
        f"{prose(62, 50)}\n{items[1].upper()}\n",
        f"{prose(63, 40)} and {other} {prose(64, 10)}",
        f"{prose(63, 40)} and {mixed} {prose(64, 10)}",
        prose(65, 300),
        f"{prose(66, 30)} {' '.join(items[0].split()[:4])} {prose(67, 30)}",
    ]
    df = make([*texts, *docs, docs[1]], [*ids, 40, 41, 42, 43, 44, 45, 41])
    rows = templates.leaks(df, bench).collect()
    got = sorted((r.doc_id, r.item_id, r.reparameterised) for r in rows)
    assert got == [(40, 0, False), (41, 1, False), (41, 5, False), (42, 2, True)]
    first = {(r.doc_id, r.item_id): r.first_word for r in rows}
    assert abs(first[40, 0] - 200) <= 1
    left = templates.clean(df, bench)
    assert left.columns == df.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter([*ids, 43, 44, 45])
    assert templates.leaks(make([]), bench).count() == 0
    assert templates.leaks(df, bench.limit(0)).count() == 0


def test_licenses_with_other_blanks(make):
    texts = [
        "All rights\u00a0reserved", "All  Rights  Reserved.", "x\nall rights-reserved\ny", "Free soft\nware",
        "Permission\u00a0is hereby granted, free of charge, to any person obtaining a copy\n"
        "The  software\u00a0is provided 'as is', without warranty of any kind",
        "This program is free\u00a0software: you can redistribute it and/or modify it\n"
        "See the GNU General Public\u00a0License for more details",
    ]
    got = sorted((r.doc_id, r.rule) for r in licenses.scan(make(texts)).collect())
    assert got == [(0, "reserved-line"), (1, "reserved-line"), (2, "reserved-line"), (4, "mit-text"), (5, "gpl-notice")]
    cues = re.compile(licenses.CUES)
    assert all(any(cues.search(w) for w in s.split()) for s in licenses.SENTENCES)


def test_leaks_of_items_without_good_windows(spark, make, prose):
    items = [
        "What is 12 plus 30", "7 9 12 14 18 21 25 30 33 41 47", "Paris",
        "The Old Man And The Sea By Ernest Hemingway Was Printed Here", "!?",
    ]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = [f"{prose(70 + i, 60)} {x} {prose(80 + i, 60)}" for i, x in enumerate(items)]
    docs += ["what is 40 plus 2", docs[0].replace("12", "13"), docs[1].replace("18", "19"), prose(90, 80)]
    rows = templates.leaks(make(docs), bench).collect()
    got = sorted((r.doc_id, r.item_id, r.n_windows, r.n_matched, r.reparameterised) for r in rows)
    assert got == [(0, 0, 1, 1, False), (1, 1, 4, 4, False), (2, 2, 1, 1, False), (3, 3, 5, 5, False), (5, 0, 1, 1, True)]
    assert {r.doc_id: r.first_word for r in rows}[2] == 60


def test_leaks_with_one_changed_mention(spark, make, prose):
    words = prose(95, 59).lower().replace(".", "").split()
    words[10] = words[40] = "Anna"
    many = list(words)
    for at in range(4, 59, 6):
        many[at] = "Anna"
    bench = spark.createDataFrame([(0, " ".join(words)), (1, " ".join(many))], "item_id long, text string")
    once, one_of_many = list(words), list(many)
    once[40] = one_of_many[28] = "Maria"
    docs = [f"{prose(96, 30)} {' '.join(x)} {prose(97, 30)}" for x in (once, one_of_many)]
    rows = {(r.doc_id, r.item_id): r for r in templates.leaks(make(docs), bench).collect()}
    assert (0, 0) in rows and (1, 1) in rows
    # a tie takes away the windows of both mentions, a minority its own ones
    assert (rows[0, 0].n_windows, rows[0, 0].n_matched) == (52, 52 - 16)
    assert rows[1, 1].n_matched == rows[1, 1].n_windows - 8
    assert not rows[0, 0].reparameterised and not rows[1, 1].reparameterised


def test_leaks_in_another_case_or_wrapped(spark, make, prose):
    items = [
        "What is the capital city of the country France and how many people live in it today",
        "Why did Anna from Oslo meet Peter and Maria in Rome before Juan and Karl went on to Paris with Eva",
    ]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    def column(text):
        return "\n".join(text.split())

    def quoted(text):
        return '"' + text.replace(" ", " , ") + '"'

    forms = [str, str.lower, str.upper, lambda x: x.replace(" ", "  "), column, quoted]
    docs = [f"{prose(110 + i, 60)} {f(x)} {prose(130 + i, 60)}" for i, x in enumerate(items) for f in forms]
    docs += [prose(150, 200), f"{prose(151, 40)} {' '.join(items[0].split()[:9])} {prose(152, 40)}"]
    rows = templates.leaks(make(docs), bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(i, i // 6) for i in range(12)]


def test_leaks_against_all_windows(spark, make):
    """Texts of a few lower-case words: an item leaks if a quarter of its windows stand in the text."""
    draw = random.Random(17)
    words = ["red", "blue", "green", "stone"]
    bench = [" ".join(draw.choice(words) for _ in range(n)) for n in (3, 6, 8, 9, 11, 14, 20, 26)]
    texts = [" ".join(draw.choice(words) for _ in range(draw.randint(1, 60))) for _ in range(60)]
    for i in range(40):
        item = draw.choice(bench).split()
        at = draw.randrange(len(item))
        texts[i] = f"{texts[i]} {' '.join(item[at:] + ['sea'])} {texts[-i]}"
    found = templates.leaks(
        make(texts), spark.createDataFrame(list(enumerate(bench)), "item_id long, text string")
    )
    wanted = set()
    for d, text in enumerate(texts):
        have = text.split()
        for i, item in enumerate(bench):
            item = item.split()
            w = min(8, len(item))
            seen = {tuple(have[k : k + w]) for k in range(len(have) - w + 1)}
            places = range(len(item) - w + 1)
            n = sum(tuple(item[k : k + w]) in seen for k in places)
            if 4 * n >= len(places):
                wanted.add((d, i, len(places), n))
    got = {(r.doc_id, r.item_id, r.n_windows, r.n_matched) for r in found.collect()}
    assert got == wanted and len(got) > 30


def test_lengths(make, odd):
    texts, ids = odd
    encode = lengths.encoder(PATH).encode_ordinary
    sizes = [len(encode(t or "")) for t in texts]
    hist = lengths.histogram(make(texts, ids), PATH)
    answers = lengths.limits(hist, wanted=(3, 1000))
    for r in answers.collect():
        assert r.n_docs == sizes.count(r.length)
        assert r.docs_longer == sum(s > r.length for s in sizes)
        assert r.tokens_longer == sum(s for s in sizes if s > r.length)
        assert r.tokens_at_limit == sum(min(s, r.length) for s in sizes)
        assert (r.total_docs, r.total_tokens) == (len(sizes), sum(sizes))
    assert {r.length for r in answers.collect()} == {*sizes, 3, 1000}
    assert lengths.quantile(answers, 0.5) == sorted(sizes)[len(sizes) // 2 - 1]
    assert lengths.limits(lengths.histogram(make([]), PATH)).count() == 0


def test_packing(make, odd, prose):
    texts, ids = odd
    texts = [*texts, *[prose(i, 5 + 37 * i % 900) for i in range(200)]]
    ids = [*ids, *range(100, 300)]
    sizes = (64, 256, 1024)
    rows = packing.best_fit(make(texts, ids), sizes=sizes, pieces_per_shard=90).collect()
    total = Counter()
    for r in rows:
        total[r.doc_id] += r.length
    wanted = Counter()
    for i, t in zip(ids, texts, strict=True):
        wanted[i] += len((t or "").encode().split()) + 1
    assert total == wanted
    bins = {}
    for r in rows:
        bins.setdefault((r.shard, r.bin), []).append(r)
    for members in bins.values():
        used = sum(r.length for r in members)
        capacity = {r.capacity for r in members}
        assert capacity == {min(s for s in sizes if s >= used)}
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
    waste = sum(m[0].capacity - sum(r.length for r in m) for m in bins.values())
    assert waste < 0.1 * sum(wanted.values())
    assert packing.best_fit(make([])).count() == 0


def test_several_sizes_waste_less(prose):
    sizes = [5 + (i * 7919) % 700 for i in range(500)]
    several = packing.pack(sizes, (128, 512, 1024))
    one = packing.pack(sizes, (1024,))

    def cost(packed):
        return sum({b: c + packing.OVERHEAD for b, c in zip(packed[0], packed[2], strict=True)}.values())

    assert cost(several) <= cost(one)


def packing_cost(capacities):
    return sum(c + packing.OVERHEAD for c in capacities)


@pytest.mark.parametrize("mix", ["long", "odd", "short", "broad"])
def test_no_single_size_is_cheaper(mix):
    """The sizes opened follow the pieces: what wastes a large size opens a smaller one."""
    draw = random.Random(3)
    sizes = packing.SIZES
    if mix == "long":
        lengths, sizes = [1500] * 4000, (1536, 4096)
    elif mix == "odd":
        lengths = [1030] * 4000
    elif mix == "short":
        lengths = [min(4096, max(1, int(draw.lognormvariate(5.5, 1)))) for _ in range(4000)]
    else:
        lengths = [min(4096, max(1, int(draw.lognormvariate(7, 0.6)))) for _ in range(4000)]
    _, _, first, final = packing.placed(lengths, sizes, packing.OVERHEAD)
    capacity = {}
    for b, c in zip(*packing.pack(lengths, sizes)[::2], strict=True):
        capacity[b] = c
    for one in (s for s in sizes if s >= max(lengths)):
        alone = packing.placed(lengths, (one,), packing.OVERHEAD)[3]
        # the joint choice by itself is about as good, the packing that stays is no dearer
        assert packing_cost(final) <= 1.01 * packing_cost(alone)
        assert packing_cost(capacity.values()) <= packing_cost(alone)
    if mix == "long":
        assert Counter(first) == {1536: 4000}
    if mix == "broad":
        assert {1024, 2048, 4096} <= set(first)
        assert packing_cost(final) < packing_cost(packing.placed(lengths, (4096,), packing.OVERHEAD)[3])


def test_packing_against_the_best_of_all():
    """Up to eight pieces, all partitions: never below the best, and close to it."""
    draw, sizes, dearer = random.Random(11), (16, 32, 64), []
    for _ in range(150):
        lengths = [draw.randint(1, 64) for _ in range(draw.randint(1, 8))]
        full = (1 << len(lengths)) - 1
        total = [sum(x for i, x in enumerate(lengths) if m >> i & 1) for m in range(full + 1)]
        best = [0] + [10**9] * full
        for m in range(1, full + 1):
            low, part = m & -m, m
            while part:
                if part & low and total[part] <= sizes[-1]:
                    price = packing.downsized(total[part], sizes) + 4
                    best[m] = min(best[m], best[m ^ part] + price)
                part = (part - 1) & m
        bins, _, capacity = packing.pack(lengths, sizes, 4)
        cost = sum({b: c + 4 for b, c in zip(bins, capacity, strict=True)}.values())
        assert cost >= best[full]
        dearer.append(cost / best[full])
    assert max(dearer) < 1.5 and sum(dearer) / len(dearer) < 1.05


def test_much_junk_does_not_move_the_limits(make, prose):
    """Two documents in five of a source are repeated lines and symbols; another source has symbols only."""
    clean = ["\n".join(prose(100 * i + j, 15) for j in range(6)) for i in range(60)]
    junk = ["\n".join(f"{prose(i * 50 + k, 5)} # * &\nread more here" for k in range(12)) for i in range(40)]
    symbols = [" ".join(f"{w} # $" if n % 2 else w for n, w in enumerate(prose(9000 + i, 80).split()))
               for i in range(60)]
    sources = ["mixed"] * 100 + ["symbols"] * 60
    docs = make(clean + junk + symbols, sources=sources)
    judged = rules.judged(docs)
    assert not judged.where("base_failed").count()
    kept = {r.doc_id for r in judged.where("kept").select("doc_id").collect()}
    assert kept & set(range(60, 100)) == set()
    assert set(range(60)) <= kept and set(range(100, 160)) <= kept


def test_windows_of_documents_are_those_of_items_and_compiled(spark, make, prose):
    """One row for each window, with the hashes that items have; no function of array elements."""
    texts = [None, "", "...", "one", "Anna ran 5 km", prose(1, 8), prose(2, 9), "Da sagt Anna: 12 kg, " * 5]
    docs = make(texts)
    for widths in ([], [3, 8], [1, 2, 8]):
        got = templates.probed(docs, widths)
        assert "lambda" not in got._jdf.queryExecution().optimizedPlan().toString()
        t, raw = templates.template_words(F.col("text")), templates.raw_words(F.col("text"))
        lists = [templates.listed(templates.windows(t), F.lit(0))]
        lists += [templates.listed(templates.exact_windows(raw, w), F.lit(w)) for w in widths]
        expected = docs.select("doc_id", F.explode(F.concat(*lists)).alias("w")).select(
            "doc_id", "w.at", "w.hash", "w.width"
        )
        found = got.where("hash is not null").select("doc_id", F.col("doc_at").alias("at"), "hash", "width")
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
