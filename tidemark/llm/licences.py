"""Licence scans: a trained paragraph classifier, confirmed by templates."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch

# The wording of common licence notices.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    (
        "apache",
        "You may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software Foundation",
    ),
    ("lgpl", "This library is licensed under the GNU Lesser General Public License, version 2.1"),
    ("agpl", "This work is licensed under the GNU Affero General Public License, version 3"),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    ("bsd", "Released under the BSD 3-Clause License"),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    (
        "cc-by-nc",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License",
    ),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    (
        "cc-by-sa",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
        "International License",
    ),
    ("cc-by", "Licensed under CC BY 4.0"),
    (
        "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    ("public-domain", "This is free and unencumbered software released into the public domain"),
    ("public-domain", "CC0 1.0 Universal Public Domain Dedication"),
)
NONE, UNKNOWN = "none", "unknown"
VARIANTS = 40  # of each template to learn from
DROPPED = 15  # per cent of a variant's words that are left out
ORDINARY_WEIGHT = 6.0  # of all ordinary paragraphs together, at most, to the versions' one
CONFIRMED = 0.6  # share of a template's n-grams that a paragraph must have
MISTAKEN = 0.001  # share of ordinary paragraphs that may pass the threshold
STEPS, RATE, DECAY = 20, 0.4, 1e-4
BIAS = ""  # an n-gram that every paragraph has
SHARES = 1 << 30


class Model(NamedTuple):
    classes: list[str]
    weights: list[tuple]  # each n-gram and its weight for each class
    threshold: float


def words(text: Column) -> Column:
    """Lower-cased words; digits and signs other than the hyphen only separate."""
    return F.array_remove(F.split(F.lower(text), r"[\x00-\x2c\x2e-\x60\x7b-\x7f]+"), "")


def grams(listed: Column) -> Column:
    """Pairs and triples of neighbouring words; nulls where the list ends."""
    after = F.slice(listed, F.lit(2), F.size(listed))
    pairs = F.zip_with(listed, after, lambda x, y: F.concat(x, F.lit(" "), y))
    third = F.slice(listed, F.lit(3), F.size(listed))
    return F.concat(pairs, F.zip_with(pairs, third, lambda x, y: F.concat(x, F.lit(" "), y)))


def _with_bias(known: str) -> Column:
    return F.concat(known, F.array(F.lit(BIAS)))


def _grams_over(last: Column, after: Column) -> Column:
    """Pairs and triples that begin in ``last`` (two words at most) and end in ``after``."""
    x, y, z = F.get(F.reverse(last), F.lit(0)), F.get(after, F.lit(0)), F.get(after, F.lit(1))
    w = F.get(F.reverse(last), F.lit(1))
    gap = F.lit(" ")
    return F.array(F.concat(x, gap, y), F.concat(x, gap, y, gap, z), F.concat(w, gap, x, gap, y))


class Scanner:
    """The templates' n-grams, and models over them.

    Tables of the templates hold a few hundred rows, fixed by TEMPLATES, and are
    broadcast.
    """

    def __init__(self, scratch: Scratch, templates: Sequence[tuple[str, str]] = TEMPLATES):
        self.scratch, self.spark = scratch, scratch.spark
        named = [(i, family, text) for i, (family, text) in enumerate(templates)]
        frame = self.spark.createDataFrame(named, "template int, family string, text string")
        self.templates = frame.select("template", "family", words(F.col("text")).alias("words"))
        every = F.array_distinct(F.array_compact(grams(F.col("words"))))
        rows = self.templates.select("template", "family", every.alias("grams")).collect()
        parts = [(r["template"], r["family"], len(r["grams"]), g) for r in rows for g in r["grams"]]
        self.parts = self.spark.createDataFrame(
            parts, "template int, family string, length int, gram string"
        )
        self.grams = sorted({p[3] for p in parts})
        self.own_words = sorted({w for g in self.grams for w in g.split(" ")})
        self.families = sorted({r["family"] for r in rows})
        self.longest = self.templates.agg(F.max(F.size("words"))).first()[0] or 0

    def known_pairs(self, listed: Column) -> Column:
        """For each word the pair that begins with it, if both are words of templates."""
        own = lambda w: w.isin(self.own_words)
        after = F.slice(listed, F.lit(2), F.size(listed))
        return F.zip_with(listed, after, lambda x, y: F.when(own(x) & own(y), F.concat(x, F.lit(" "), y)))

    def known_grams(self, pairs: Column, listed: Column) -> Column:
        """The templates' n-grams among the words, of which ``pairs`` are the known pairs.

        No n-gram is built of words that no template has."""
        third = F.slice(listed, F.lit(3), F.size(listed))
        triples = F.zip_with(pairs, third, lambda x, y: F.concat(x, F.lit(" "), y))
        return F.array_intersect(F.array_compact(F.concat(pairs, triples)), F.lit(self.grams))

    def known(self, lines: DataFrame, name: str) -> DataFrame:
        """(id, doc_id, paragraph, known) of the paragraphs with an n-gram of a template.

        Written, so that the ids are fixed.
        """
        known = self.known_grams(self.known_pairs(F.col("words")), F.col("words"))
        # The id keeps the filter above, so that the n-grams are taken once.
        numbered = F.monotonically_increasing_id().alias("id")
        found = lines.select(numbered, "doc_id", "paragraph", known.alias("known"))
        return self.scratch.save(found.filter(F.size("known") > 0), name)

    def shares(self, found: DataFrame) -> DataFrame:
        """(id, family, share): the largest part of a template of the family that is there."""
        hits = found.select("id", F.explode("known").alias("gram"))
        hits = hits.join(F.broadcast(self.parts), "gram")
        by_template = hits.groupBy("id", "family", "template").agg(
            (F.count("*") / F.first("length")).alias("share")
        )
        return by_template.groupBy("id", "family").agg(F.max("share").alias("share"))

    def ordinary(self, lines: DataFrame) -> DataFrame:
        """(id, known, learnt, test): every different set of known n-grams among the lines
        that have some but not most of a template's, with its numbers of lines.  Written.

        To the models a line is its set, so nothing is left out.  A fifth of the lines, by
        a hash of their place, is ``test``.
        """
        test = F.pmod(F.xxhash64(F.lit("t"), "doc_id", "paragraph"), F.lit(100)) < 20
        sets = (
            lines.filter(F.size("known") > 0)
            .groupBy(F.sort_array("known").alias("known"))
            .agg(F.count_if(~test).alias("learnt"), F.count_if(test).alias("test"))
        )
        sets = self.scratch.save(sets.withColumn("id", F.monotonically_increasing_id()), "sets")
        near = self.shares(sets).filter(F.col("share") >= CONFIRMED).select("id").distinct()
        return self.scratch.save(sets.join(near, "id", "left_anti"), "ordinary")

    def train(self, lines: DataFrame) -> Model:
        """Multinomial logistic regression on the templates and ordinary paragraphs.

        Templates are learnt in VARIANTS versions with words left out.  Ordinary are all
        of ``lines`` that have an n-gram of some template but not most of one; so that
        many of them do not drown the templates, each counts for less where together they
        would weigh more than ORDINARY_WEIGHT times the versions.  A fifth of them is held
        out and sets the threshold below which a licence is unknown, so that one in 1000
        passes by mistake.
        """
        draw = lambda *c: F.pmod(F.xxhash64(*c), F.lit(100))
        version = F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))).alias("paragraph")
        word = self.templates.select("template", "family", "words", version).select(
            "template", "family", "paragraph", F.posexplode("words").alias("place", "word")
        )
        left = (F.col("paragraph") == 0) | (draw("template", "paragraph", "place") >= DROPPED)
        listed = F.sort_array(F.collect_list(F.struct("place", "word")))
        own = word.filter(left).groupBy("template", "family", "paragraph").agg(listed.alias("w"))
        own = own.select(F.col("family").alias("doc_id"), "paragraph", F.col("w.word").alias("words"))
        own = self.known(own, "versions")

        ordinary = self.ordinary(lines)
        learnt = ordinary.agg(F.sum("learnt")).first()[0] or 0
        each = min(1.0, ORDINARY_WEIGHT * own.count() / max(1, learnt))

        classes = [NONE, *self.families]
        numbers = self.spark.createDataFrame(list(enumerate(classes)), "label int, doc_id string")
        rows = own.join(F.broadcast(numbers), "doc_id").select(
            "label", F.lit(1.0).alias("weight"), "known"
        )
        weighed = (F.col("learnt") * each).alias("weight")
        rows = rows.union(ordinary.filter("learnt > 0").select(F.lit(0), weighed, "known"))
        weights = self._fit(rows, len(classes))
        model = Model(classes, [(g, *w) for g, w in weights.items()], 0.5)
        licence = F.greatest(*[F.col(f"p{c}") for c in range(1, len(classes))])
        held = self.chances(ordinary.filter("test > 0"), model)
        # counted by chances to a millionth, so no task holds more than a million of them
        held = held.join(ordinary, "id").groupBy(F.round(licence, 6).alias("p")).agg(F.sum("test").alias("n"))
        held = held.agg(F.percentile("p", 1 - MISTAKEN, F.col("n")))
        return model._replace(threshold=max(0.5, held.first()[0] or 0.0))

    def _fit(self, rows: DataFrame, classes: int) -> dict[str, list[float]]:
        """Weights of each n-gram for each class, by STEPS steps of gradient descent over
        (label, weight, known) rows.

        A step is one job over the rows' n-grams; the weights, a few hundred rows
        fixed by the templates, go out by broadcast and their slopes come back.
        Steps are scaled by running means of the slopes and of their squares.
        """
        hits = rows.select(F.monotonically_increasing_id().alias("id"), "label", "weight", "known")
        hits = hits.select("id", "label", "weight", F.explode(_with_bias("known")).alias("gram"))
        hits = self.scratch.save(hits, "hits")
        total = hits.filter(F.col("gram") == BIAS).agg(F.sum("weight")).first()[0] or 1.0
        weights = {g: [0.0] * classes for g in (BIAS, *self.grams)}
        weights[BIAS][0] = 2.0  # most paragraphs have no n-gram of a template
        mean = {g: [0.0] * classes for g in weights}
        square = {g: [0.0] * classes for g in weights}
        for step in range(1, STEPS + 1):
            table = [(g, *w) for g, w in weights.items()]
            chances = self._softmax(hits, table, ["id", "label", "weight"])
            errors = [
                (F.col("weight") * (F.col(f"p{c}") - (F.col("label") == c).cast("double"))).alias(f"e{c}")
                for c in range(classes)
            ]
            slopes = hits.select("id", "gram").join(chances.select("id", *errors), "id")
            slopes = slopes.groupBy("gram").agg(*[F.sum(f"e{c}") for c in range(classes)])
            for gram, *slope in slopes.collect():
                w, m, v = weights[gram], mean[gram], square[gram]
                for c in range(classes):
                    g = slope[c] / total + DECAY * w[c]
                    m[c] = 0.8 * m[c] + 0.2 * g
                    v[c] = 0.95 * v[c] + 0.05 * g * g
                    size = (v[c] / (1 - 0.95**step)) ** 0.5 + 1e-8
                    w[c] -= RATE * (m[c] / (1 - 0.8**step)) / size
        return weights

    def _softmax(self, hits: DataFrame, weights: list[tuple], key: list[str]) -> DataFrame:
        count = range(len(weights[0]) - 1)
        kind = "gram string, " + ", ".join(f"w{c} double" for c in count)
        table = F.broadcast(self.spark.createDataFrame(weights, kind))
        sums = hits.join(table, "gram").groupBy(*key).agg(
            *[F.exp(F.least(F.sum(f"w{c}"), F.lit(50.0))).alias(f"e{c}") for c in count]
        )
        sums = sums.withColumn("total", sum((F.col(f"e{c}") for c in count), F.lit(0.0)))
        return sums.select(*key, *[(F.col(f"e{c}") / F.col("total")).alias(f"p{c}") for c in count])

    def chances(self, found: DataFrame, model: Model) -> DataFrame:
        """(id, p0, p1, …): the probability of each class."""
        hits = found.select("id", F.explode(_with_bias("known")).alias("gram"))
        return self._softmax(hits, model.weights, ["id"])

    def lines(self, docs: DataFrame) -> DataFrame:
        """(id, row, doc_id, paragraph, n, head, last, known, end_known): every line, its
        outer words, its known n-grams and those of its last ``longest`` words.  Written.

        A break of two signs is one; the piece between them is not a line of its own.
        """
        text = F.replace(F.col("text"), F.lit("\r\n"), F.lit("\r\x01\n"))
        rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text.alias("text"))
        split = rows.select(
            "row", "doc_id", F.posexplode(F.split("text", "[\r\n]")).alias("paragraph", "line")
        )
        split = split.filter(F.col("line") != "\x01")
        listed = split.select("row", "doc_id", "paragraph", words(F.col("line")).alias("words"))
        # taken once, for the pairs and for the triples
        listed = listed.withColumn("pairs", self.known_pairs(F.col("words")))
        n = F.size("words")
        known = lambda w: self.known_grams(self.known_pairs(w), w)
        end = F.slice("words", F.greatest(n - self.longest + 1, F.lit(1)), F.lit(self.longest))
        last = F.slice("words", F.greatest(n - 1, F.lit(1)), F.lit(2))
        kept = listed.select(
            F.monotonically_increasing_id().alias("id"),
            "row", "doc_id", "paragraph", n.alias("n"),
            F.slice("words", 1, 2).alias("head"), last.alias("last"),
            self.known_grams(F.col("pairs"), F.col("words")).alias("known"),
            F.when(n > self.longest, known(end)).alias("end_known"),
        )
        return self.scratch.save(kept, "lines")

    def wrapped(self, lines: DataFrame, sure: DataFrame) -> DataFrame:
        """(id, doc_id, paragraph, until, row, run, place, known): neighbouring non-empty lines with
        an n-gram over a line break, from each line on.  Written.

        A window begins in the last ``longest`` words of a line and reaches over the lines
        that begin in the ``longest`` words after that line, so it holds any notice
        of that length, however it is wrapped.  Lines that are a notice alone, ``sure``,
        are left out: they are found already.
        """
        of_row = Window.partitionBy("row").orderBy("paragraph")
        after = F.concat(F.lead("head", 1).over(of_row), F.coalesce(F.lead("head", 2).over(of_row), F.array().cast("array<string>")))
        after = F.when(F.lead("n", 1).over(of_row) > 0, after)
        gone = sure.select("id", F.lit(True).alias("sure"))
        placed = (
            lines.select(
                "*",
                F.sum("n").over(of_row).alias("end"),
                F.sum((F.col("n") == 0).cast("int")).over(of_row).alias("run"),
                after.alias("after"),
            )
            .filter("n > 0")
            .withColumn("over", F.array_intersect(F.array_compact(_grams_over(F.col("last"), F.col("after"))), F.lit(self.grams)))
            .withColumn("over", F.coalesce("over", F.array().cast("array<string>")))
            .filter("size(known) > 0 OR size(over) > 0")
            .join(gone, "id", "left")
            .filter("sure IS NULL")
        )
        whole = F.struct(
            (F.col("end") - F.col("n")).alias("place"),
            F.array_union("known", "over").alias("grams"),
            (F.col("n") <= self.longest).alias("first"),
        )
        ending = F.struct(
            (F.col("end") - self.longest).alias("place"),
            F.array_union(F.coalesce("end_known", F.array().cast("array<string>")), "over").alias("grams"),
            F.lit(True).alias("first"),
        )
        pieces = F.when(F.col("n") > self.longest, F.array(whole, ending)).otherwise(F.array(whole))
        pieces = placed.select("row", "doc_id", "paragraph", "run", "over", F.explode(pieces).alias("p"))
        pieces = pieces.select("row", "doc_id", "paragraph", "run", "over", "p.*")
        reach = Window.partitionBy("row", "run").orderBy("place").rangeBetween(0, 2 * self.longest)
        open_ = pieces.select(
            "row", "doc_id", "paragraph", "run", "place", "first",
            F.max("paragraph").over(reach).alias("until"),
            F.sum(F.size("over")).over(reach).alias("n_over"),
            F.collect_list("grams").over(reach).alias("all"),
        )
        open_ = open_.filter("first AND until > paragraph AND n_over > 0")
        known = F.array_distinct(F.flatten("all")).alias("known")
        numbered = F.monotonically_increasing_id().alias("id")
        found = open_.select(numbered, "doc_id", "paragraph", "until", "row", "run", "place", known)
        return self.scratch.save(found, "wrapped")

    def told(self, found: DataFrame, model: Model, name: str) -> DataFrame:
        """``found`` where the classifier sees a licence, with predicted, probability,
        template_share and whether both confirm it, as ``sure``.  Written."""
        chances = [F.col(f"p{c}") for c in range(len(model.classes))]
        best = F.greatest(*chances)
        named = F.coalesce(*[F.when(p == best, c) for p, c in zip(chances, model.classes, strict=True)])
        told = self.chances(found, model).select(
            "id", named.alias("predicted"), best.alias("probability")
        )
        told = self.scratch.save(told.filter(F.col("predicted") != NONE), f"{name}-told")
        taken = found.join(told, "id")
        shares = self.shares(taken).withColumnRenamed("family", "predicted")
        sure = (F.col("probability") >= model.threshold) & (F.col("template_share") >= CONFIRMED)
        judged = (
            taken.join(shares, ["id", "predicted"], "left")
            .withColumn("template_share", F.coalesce("share", F.lit(0.0)))
            .withColumn("sure", sure)
            .drop("known", "share")
        )
        return self.scratch.save(judged, f"{name}-judged")

    def scan(self, lines: DataFrame, model: Model) -> DataFrame:
        # A paragraph without any known n-gram has the bias's class, which is none.
        found = lines.filter(F.size("known") > 0).select("id", "row", "doc_id", "paragraph", "known")
        alone = self.told(found, model, "alone")
        windows = self.told(self.wrapped(lines, alone.filter("sure")), model, "wrapped")
        # Of overlapping windows the best stays, of those alike the one that begins last.
        before = Window.partitionBy("row", "run", "predicted").orderBy("place")
        rank = F.struct("sure", "template_share")
        worse = (F.max(rank).over(before.rangeBetween(-self.longest, -1)) > rank) | (
            F.max(rank).over(before.rangeBetween(1, self.longest)) >= rank
        )
        windows = windows.withColumn("worse", F.coalesce(worse, F.lit(False))).filter("NOT worse")
        # A hit that is not confirmed gives way to what covers the same lines.
        inside = lambda x, y: (F.col(f"{x}.row") == F.col(f"{y}.row")) & F.col(f"{x}.paragraph").between(F.col(f"{y}.paragraph"), F.col(f"{y}.until"))
        same = inside("a", "w") & (F.col("a.predicted") == F.col("w.predicted")) & ~F.col("a.sure")
        lone = alone.alias("a").join(windows.filter("sure").alias("w"), same, "left_anti")
        covered = ~F.col("w.sure") & inside("a", "w")
        windows = windows.alias("w").join(alone.alias("a"), covered, "left_anti")
        told = lone.unionByName(windows.drop("until", "run", "place", "worse"))
        return told.select(
            "doc_id",
            "paragraph",
            F.when(F.col("sure"), F.col("predicted")).otherwise(UNKNOWN).alias("family"),
            "predicted",
            "probability",
            "template_share",
        )


def licences(docs: DataFrame) -> DataFrame:
    """(doc_id, paragraph, family, predicted, probability, template_share): one row for
    every paragraph of ``docs`` that the classifier takes for a licence notice.

    A paragraph is a line, or neighbouring non-empty lines if a notice is wrapped;
    then ``paragraph`` is the line where it begins.  The pairs and triples of words,
    over line breaks too, are weighed by a logistic regression over licence families
    and all ordinary lines of ``docs``.  ``family`` is ``unknown`` if the probability is below the
    calibrated threshold or the paragraph has less than 0.6 of the n-grams of every
    template of the family.  Of overlapping wrapped hits of a family the best is told.

    Null and empty texts have no paragraphs; repeated rows give repeated rows; a
    null doc_id is passed through.  Very long texts are split into their lines, in the
    JVM; an empty table gives no rows; other columns are not looked at.  Without ordinary text to learn from, the
    templates and empty paragraphs are learnt.
    """
    scanner = Scanner(Scratch(docs.sparkSession, "licences"))
    lines = scanner.lines(docs.select("doc_id", "text"))
    return scanner.scan(lines, scanner.train(lines))
