"""Licence scans: a trained paragraph classifier, confirmed by templates.

Paragraphs end at blank lines. Wrapped lines are rejoined: units are single lines and runs of neighbouring lines of a
paragraph that a template's words can span, each rejoined by blanks (of a run's first and last line only as many words
as the longest template has). Features are word n-grams (one to three words) that hold a word of CUES; the classes are
licence families and `unknown`. A logistic regression is fitted on the templates below, whole and with words left out or
mixed in, and on lines that say nothing of licences; the temperature that makes held-out variants likeliest calibrates
it. A unit without a cue has no feature and is unknown.

A family is a candidate in a unit if it is likelier than `unknown`, one of its templates shares COMMON of its words with
the unit, and (as GPL words are in every LGPL grant) one of the cue words they share is in no template of a likelier
candidate. It is reported if its probability, given that it is none of the other candidates, reaches CERTAIN. Of runs of
a family that overlap the narrowest counts, then the one with the larger share; its first line is the place. A run
also takes the place of a narrower one inside it that it explains (CC BY / NC in two lines).

Scoring is joins and sums over distinct lines; weights are as many as the templates' n-grams.

Defined results: a null text is an empty one; documents without licence lines have zero counts and an empty list; equal
rows give equal rows; an empty table gives none; other columns are left alone.
"""

import random
import re
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

# Licence families and sentences that name or grant them.
TEMPLATES = {
    "mit": [
        "released under the mit license",
        "licensed under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
        "spdx license identifier mit",
    ],
    "apache": [
        "licensed under the apache license version 2.0",
        "you may not use this file except in compliance with the apache license",
        "spdx license identifier apache 2.0",
        "released under the apache 2.0 license",
    ],
    "gpl": [
        "this work is licensed under the gnu general public license version 3",
        "licensed under the gpl version 2 or later",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
        "you should have received a copy of the gnu general public license along with this program",
        "spdx license identifier gpl 3.0 or later",
    ],
    "lgpl": [
        "licensed under the gnu lesser general public license version 2.1",
        "redistribute it under the terms of the gnu lesser general public license",
        "spdx license identifier lgpl 2.1",
        "released under the lgpl license",
    ],
    "agpl": [
        "licensed under the gnu affero general public license version 3",
        "spdx license identifier agpl 3.0",
        "released under the agpl license",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "licensed under the bsd 3 clause license",
        "released under the bsd license",
        "spdx license identifier bsd 2 clause",
    ],
    "mpl": [
        "this source code form is subject to the terms of the mozilla public license v. 2.0",
        "licensed under the mozilla public license version 2.0",
        "spdx license identifier mpl 2.0",
    ],
    "cc-by": [
        "licensed under cc by 4.0",
        "this work is licensed under a creative commons attribution 4.0 international license",
        "licensed under cc by sa 4.0",
        "creative commons attribution sharealike license",
    ],
    "cc-by-nc": [
        "licensed under cc by nc 4.0",
        "this work is licensed under a creative commons attribution noncommercial 4.0 international license",
        "licensed under cc by nc sa 4.0",
        "creative commons attribution noncommercial noderivatives license cc by nc nd",
    ],
    "public-domain": [
        "this is free and unencumbered software released into the public domain",
        "dedicated to the public domain under cc0 1.0 universal",
        "spdx license identifier cc0 1.0",
    ],
    "proprietary": [
        "all rights reserved no part of this work may be reproduced without permission of the copyright holder",
        "proprietary and confidential unauthorized copying is prohibited",
        "this software is proprietary and may not be redistributed without a license",
    ],
}
# Words that a feature must hold one of.
CUES = (
    "license licensed licence licenced license's copyright permission spdx gnu gpl lgpl agpl mit apache bsd mpl mozilla cc cc0"
    " creative commons affero lesser redistribute redistribution redistributed proprietary confidential unencumbered public reserved"
    " noncommercial nc sharealike attribution clause rights reproduced"
).split()
# Lines with cue words that grant nothing.
NOTHING = [
    "the public was invited to the opening of the library",
    "she asked for permission to leave the room",
    "a driving license is needed to rent a car",
    "he has a licence to sell flowers in the market",
    "copyright law was discussed in the second session",
    "all seats are reserved for members",
    "the apache helicopter landed at the airport",
    "a lesser known clause of the treaty",
    "the commons voted on public transport",
    "creative people need rights and attribution",
    "he studied at mit and works in public health",
    "confidential talks about the rights of the public",
]
FAMILIES = (*TEMPLATES, "unknown")
CERTAIN, COMMON, GRAMS, VARIANTS = 0.5, 0.6, 3, 40
_NOT_WORD = r"[^a-z0-9.']+"
_NOT_RUN, _RUN_WORD = r"[^A-Za-z0-9.']+", r"[A-Za-z0-9][A-Za-z0-9.']*"
CUE_LINE = r"(?i)\b(?:" + "|".join(map(re.escape, CUES)) + r")\b"


def words_of(line: str) -> list[str]:
    return [w.strip(".'") for w in re.split(_NOT_WORD, line.lower()) if w.strip(".'")]


def grams_of(words: list[str]) -> set[str]:
    every = (" ".join(words[i : i + n]) for n in range(1, GRAMS + 1) for i in range(len(words) - n + 1))
    return {g for g in every if set(g.split()) & _CUES}


_CUES = frozenset(CUES)
#: Words of the longest template.
LONGEST = max(len(words_of(t)) for templates in TEMPLATES.values() for t in templates)


def _variants(line: str, rng: random.Random, n: int) -> list[list[str]]:
    """The line's words with some left out, and with words of other lines before and after."""
    words = words_of(line)
    filler = [w for t in NOTHING for w in words_of(t) if w not in _CUES]
    out = [words]
    for _ in range(n):
        kept = [w for w in words if rng.random() > 0.08]
        lead, tail = (rng.sample(filler, rng.randrange(6)) for _ in range(2))
        out.append([*lead, *kept, *tail])
    return out


@cache
def model() -> tuple[dict[str, list[float]], list[float]]:
    """Weights of each n-gram for each family, and the intercepts, divided by the calibrating temperature."""
    rng = random.Random(8)
    rows: list[tuple[set[str], int, bool]] = []
    for number, family in enumerate(FAMILIES):
        for line in TEMPLATES.get(family, NOTHING):
            rows += [(grams_of(w), number, i % 5 == 4) for i, w in enumerate(_variants(line, rng, VARIANTS))]
    for cue in CUES:  # a cue alone among other words grants nothing
        rows += [({cue}, len(FAMILIES) - 1, False)] * 6
    rows += [(set(), len(FAMILIES) - 1, False)] * 100
    names = sorted({g for f, _, _ in rows for g in f})
    at = {g: i for i, g in enumerate(names)}
    x = np.zeros((len(rows), len(names) + 1))
    for i, (found, _, _) in enumerate(rows):
        x[i, [at[g] for g in found]] = 1
    x[:, -1] = 1
    y = np.eye(len(FAMILIES))[[r[1] for r in rows]]
    held = np.array([r[2] for r in rows])

    def softmax(z):
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    w = np.zeros((x.shape[1], len(FAMILIES)))
    train, step = x[~held], 4.0 / (x[~held].sum(1).mean())
    for _ in range(400):
        w += step * (train.T @ (y[~held] - softmax(train @ w)) / len(train) - 1e-4 * w)
    loss = lambda t: -(y[held] * np.log(softmax(x[held] @ w / t) + 1e-12)).sum()
    w /= min((0.1, 0.2, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0), key=loss)
    return {g: w[i].tolist() for g, i in at.items()}, w[-1].tolist()


def _words(line: Column) -> Column:
    return F.filter(F.transform(F.split(F.lower(line), _NOT_WORD), lambda w: F.regexp_replace(w, r"^[.']+|[.']+$", "")), lambda w: w != "")


def _grams(words: Column) -> Column:
    def of(n: int) -> Column:
        at = F.sequence(F.lit(1), F.size(words) - (n - 1))
        joined = F.transform(at, lambda i: F.array_join(F.slice(words, i, F.lit(n)), " "))
        return F.when(F.size(words) >= n, joined).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*map(of, range(1, GRAMS + 1))))


def _rated(lines: DataFrame) -> DataFrame:
    """(line, words, z) of distinct lines; z are the families with their logits."""
    weights, bias = model()
    k = len(FAMILIES)
    table = lines.sparkSession.createDataFrame([(g, *w) for g, w in weights.items()], ", ".join(["gram string", *[f"w{i} double" for i in range(k)]]))
    split = lines.select("line", _words(F.col("line")).alias("words"))
    # the weights are as many as the templates have n-grams
    hits = split.select("line", F.explode(_grams(F.col("words"))).alias("gram")).join(F.broadcast(table), "gram")
    sums = hits.groupBy("line").agg(*[F.sum(f"w{i}").alias(f"w{i}") for i in range(k)])
    joined = split.join(sums, "line", "left")
    z = F.array(*[F.struct((F.coalesce(f"w{i}", F.lit(0.0)) + F.lit(bias[i])).alias("z"), F.lit(name).alias("family")) for i, name in enumerate(FAMILIES)])
    return joined.select("line", "words", z.alias("z")).withColumn("top", F.array_max("z"))


def _templates(spark) -> DataFrame:
    known = [(name, sorted(set(words_of(t)))) for name, templates in TEMPLATES.items() for t in templates]
    return spark.createDataFrame(known, "family string, template array<string>")


def _total() -> Column:
    return F.aggregate("z", F.lit(0.0), lambda acc, x: acc + F.exp(x["z"] - F.col("top.z")))


def _share() -> Column:
    return F.size(F.array_intersect("words", "template")) / F.size("template")


def scored(lines: DataFrame) -> DataFrame:
    """(line, family, probability, confirmed) of distinct lines: the likeliest family."""
    rated = _rated(lines).select("line", "words", F.col("top.family").alias("family"), F.round(1 / _total(), 6).alias("probability"))
    # a few templates for each family
    compared = rated.join(F.broadcast(_templates(lines.sparkSession)), "family", "left").groupBy("line", "family", "probability").agg(F.max(_share()).alias("share"))
    return compared.select("line", "family", "probability", (F.coalesce("share", F.lit(0.0)) >= COMMON).alias("common")).select(
        "line", "family", "probability", (F.col("common") & (F.col("probability") >= CERTAIN)).alias("confirmed")
    )


def every_family(lines: DataFrame) -> DataFrame:
    """(line, family, probability, share, own) of the families that distinct lines are reported for; own are the cue words."""
    unknown = F.element_at("z", len(FAMILIES))["z"]
    likely = _rated(lines).withColumn("total", _total()).withColumn("x", F.explode(F.filter("z", lambda x: x["z"] > unknown)))
    likely = likely.select("line", "words", F.col("x.family").alias("family"), (F.exp(F.col("x.z") - F.col("top.z")) / F.col("total")).alias("p"))
    # a few templates for each family
    met = likely.join(F.broadcast(_templates(lines.sparkSession)), "family").withColumn("share", _share()).filter(F.col("share") >= COMMON)
    own = F.array_intersect(F.array_intersect("words", "template"), F.array(*map(F.lit, sorted(_CUES))))
    shared = met.groupBy("line", "family", "p").agg(F.max("share").alias("share"), F.array_distinct(F.flatten(F.collect_list(own))).alias("own"))
    listed = shared.groupBy("line").agg(F.sort_array(F.collect_list(F.struct("p", "family", "share", "own")), asc=False).alias("all"))

    def step(acc, x):
        distinct = ~F.exists(acc, lambda y: F.size(F.array_except(x["own"], _words_of_family(y["family"]))) == 0)
        return F.when(distinct, F.concat(acc, F.array(x))).otherwise(acc)

    none = F.array().cast("array<struct<p:double,family:string,share:double,own:array<string>>>")
    chosen = listed.withColumn("all", F.aggregate("all", none, step))
    chosen = chosen.withColumn("sum", F.aggregate("all", F.lit(0.0), lambda a, x: a + x["p"])).select("line", "sum", F.explode("all").alias("x"))
    rest = F.greatest(1 - F.col("sum") + F.col("x.p"), F.col("x.p"))
    return chosen.select("line", "x.family", F.round(F.col("x.p") / rest, 6).alias("probability"), "x.share", "x.own").filter(F.col("probability") >= CERTAIN)


def _words_of_family(family: Column) -> Column:
    """All words of a family's templates."""
    words = {name: sorted({w for t in templates for w in words_of(t)}) for name, templates in TEMPLATES.items()}
    return F.element_at(F.create_map(*[x for name, ws in words.items() for x in (F.lit(name), F.array(*map(F.lit, ws)))]), family)


def _runs(lines: DataFrame) -> DataFrame:
    """(key, number, last, line) of units that hold a cue, from (key, lines, cued): lines, and runs of neighbouring ones.

    A run's inner lines have fewer words than the longest template, so every stretch of as many words is in one.
    """
    size = LONGEST
    words = lambda line: F.filter(F.split(line, _NOT_RUN), lambda w: w != "")
    single = lines.select("key", F.explode("cued").alias("x")).select("key", "x.number", F.col("x.number").alias("last"), "x.line")
    mark = F.transform(
        "lines",
        lambda line: F.struct(F.regexp_count(line, F.lit(_RUN_WORD)).alias("n"), line.rlike(CUE_LINE).alias("cue"), line.rlike(r"\S").alias("some")),
    )

    def ends(i, marks):
        """Last lines of the runs from line i on that hold a cue."""
        first = F.get(marks, i)
        none = F.array().cast("array<int>")
        zero = F.struct(F.lit(0).alias("inner"), (first["n"] == 0).alias("shut"), first["cue"].alias("cue"), none.alias("ends"))
        following = F.transform(F.slice(marks, i + 2, F.lit(size)), lambda m, j: F.struct(m["n"].alias("n"), m["cue"].alias("cue"), m["some"].alias("some"), (i + 1 + j).alias("at")))

        def step(acc, m):
            shut, cue = acc["shut"] | ~m["some"], acc["cue"] | m["cue"]
            more = F.when(shut | ~cue | (m["n"] == 0), acc["ends"]).otherwise(F.concat(acc["ends"], F.array(m["at"])))
            inner = acc["inner"] + m["n"]
            return F.struct(inner.alias("inner"), (shut | (inner >= size - 1)).alias("shut"), cue.alias("cue"), more.alias("ends"))

        return F.aggregate(following, zero, step, lambda acc: acc["ends"])

    def joined(i, last):
        first = words(F.get("lines", i))
        lead = F.slice(first, F.greatest(F.size(first) - size + 1, F.lit(1)), F.lit(size))
        inner = F.slice("lines", i + 2, last - i - 1)
        return F.concat_ws(" ", F.array_join(lead, " "), F.array_join(inner, " "), F.array_join(F.slice(words(F.get("lines", last)), 1, F.lit(size)), " "))

    marked = lines.withColumn("marks", mark)
    places = F.transform("marks", lambda m, i: F.transform(ends(i, F.col("marks")), lambda last: F.struct(i.alias("number"), last.alias("last"))))
    placed = marked.select("key", "lines", F.flatten(places).alias("places"))
    runs = F.transform("places", lambda x: F.struct(x["number"].alias("number"), x["last"].alias("last"), joined(x["number"], x["last"]).alias("line")))
    runs = placed.select("key", F.explode(F.filter(runs, lambda x: x["line"].rlike(CUE_LINE))).alias("x"))
    return single.unionByName(runs.select("key", "x.number", "x.last", "x.line"))


def _placed(found: DataFrame) -> DataFrame:
    """(key, found): one place for each grant, from all confirmed units."""
    one = F.struct((F.col("last") - F.col("number")).alias("width"), (-F.col("share")).alias("share"), "number", "last", "family", "probability", "own")
    listed = found.groupBy("key", "family").agg(F.sort_array(F.collect_list(one)).alias("all"))
    none = "array<struct<width:int,share:double,number:int,last:int,family:string,probability:double,own:array<string>>>"
    apart = lambda acc, x: ~F.exists(acc, lambda y: (y["number"] <= x["last"]) & (x["number"] <= y["last"]))
    kept = listed.withColumn("all", F.aggregate("all", F.array().cast(none), lambda acc, x: F.when(apart(acc, x), F.concat(acc, F.array(x))).otherwise(acc)))
    whole = kept.groupBy("key").agg(F.flatten(F.collect_list("all")).alias("all"))

    def explained(x):
        inside = lambda y: (y["number"] <= x["number"]) & (x["last"] <= y["last"]) & (y["width"] > x["width"])
        return F.exists("all", lambda y: inside(y) & (y["family"] != x["family"]) & (F.size(F.array_except(x["own"], _words_of_family(y["family"]))) == 0))

    rest = F.filter("all", lambda x: ~explained(x))
    return whole.select("key", F.sort_array(F.transform(rest, lambda x: F.struct(x["number"].alias("number"), x["family"].alias("family"), x["probability"].alias("probability")))).alias("found"))


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, key, found): numbers of the licence lines of each document with family and probability."""
    text = F.coalesce("text", F.lit(""))
    key = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.xxhash64(text).cast("string"), F.xxhash64(F.lit("second"), text).cast("string"))
    keyed = docs.select("doc_id", key.alias("key"), text.alias("text"))
    numbered = F.transform(F.split("text", "\n", -1), lambda line, i: F.struct(i.alias("number"), line.alias("line")))
    cued = F.filter(numbered, lambda x: x["line"].rlike(CUE_LINE))
    has = F.col("text").rlike(CUE_LINE)
    some = keyed.withColumn("cued", F.when(has, cued)).select(
        "doc_id", "key", F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"), F.when(has, F.split("text", "\n", -1)).alias("lines"), "cued"
    )
    some = common.keep(some, "licences")
    units = common.keep(_runs(some.filter("cued is not null").select("key", "lines", "cued").dropDuplicates(["key"])), "units")
    known = every_family(units.select("line").distinct())
    found = _placed(units.join(known, "line"))
    return some.select("doc_id", "key", "n_lines").join(found, "key", "left")


def digest(docs: DataFrame) -> DataFrame:
    found = F.coalesce("found", F.array().cast("array<struct<number:int,family:string,probability:double>>"))
    listed = F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["number"].cast("string"), x["family"])), ",")
    return find(docs).select(
        "doc_id",
        "n_lines",
        F.size(found).cast("long").alias("n_licences"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda x: x["family"]))), ",").alias("families"),
        listed.alias("lines"),
        F.array_min(F.transform(found, lambda x: x["probability"])).alias("least_probability"),
    )
