"""License notices in texts, found by votes of word 2-grams on the diagonals of templates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words in a rolling gram; the shortest phrases have no more.
GRAM = 2
#: Diagonals this far apart still belong to one place: so many words may be missing or extra.
DRIFT = 3
#: Share of a notice's grams that a place must hold, and its length against that of the notice.
COVERED, STRETCH = 0.8, 1.5
# Words that tell one license from the next, besides numbers. A place must hold all grams with them.
TELLING = set("nc sharealike lesser library version".split())
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A text whose places are looked for. A phrase must stand word by word, a notice may drift."""

    text: str
    label: str
    phrase: bool = False

    @property
    def grams(self) -> int:
        return len(self.text.split()) - GRAM + 1

    @property
    def needed(self) -> int:
        """The places of the grams that tell this license from others, as bits; a template has at most 62 grams."""
        words = self.text.split()
        return sum(1 << i for i in range(self.grams) if any(w.isdigit() or w in TELLING for w in words[i : i + GRAM]))


# The phrases of the base labels, and opening words of public licenses and notices.
TEMPLATES = (
    Template("gnu general public license", "gpl", True),
    Template("apache license", "apache", True),
    Template("cc by", "cc-by", True),
    Template("mit license", "mit", True),
    Template("licensed under the apache license version 2 0", "apache-2.0"),
    Template(
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "apache-2.0",
    ),
    Template("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    Template("licensed under a creative commons attribution 4 0 international license", "cc-by-4.0"),
    Template("licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa-4.0"),
    Template("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    Template(
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
        "gpl",
    ),
    Template(
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license",
        "lgpl",
    ),
    Template(
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        "mit",
    ),
    Template(
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        "isc",
    ),
    Template(
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
        "bsd",
    ),
    Template("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    Template("this is free and unencumbered software released into the public domain", "unlicense"),
)


def template_index(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """(gram, tid, at): the hashed grams of all templates; as many rows as the templates have words."""
    rows = spark.createDataFrame([(i, t.text.split()) for i, t in enumerate(templates)], "tid int, words array<string>")
    grams = F.transform("words", lambda w, i: F.xxhash64(w, F.get(F.col("words"), i + 1)))
    return rows.select("tid", F.posexplode(F.slice(grams, 1, F.size("words") - 1)).alias("at", "gram"))


def document_grams(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(uid, id, n_words, pos, gram): all rolling grams; a text without words has one row with a null gram.

    Only A-Z are lower-cased: the two other characters whose lower case is an ASCII letter are put
    out of the way first.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    for letter in ("K", "İ"):
        text = F.replace(text, F.lit(letter), F.lit("é"))
    words = F.array_remove(F.split(F.lower(text), BREAKS), "")
    rows = df.select(F.monotonically_increasing_id().alias("uid"), F.col(f"`{id_col}`").alias("id"), words.alias("words"))
    grams = F.transform("words", lambda w, i: F.xxhash64(w, F.get(F.col("words"), i + 1)))
    rows = rows.select("uid", "id", F.size("words").cast("bigint").alias("n_words"), grams.alias("grams"))
    return rows.select("uid", "id", "n_words", F.posexplode_outer("grams").alias("pos", "gram"))


def diagonals(df: DataFrame, id_col: str, text_col: str, templates: tuple[Template, ...]) -> DataFrame:
    """(uid, id, n_words, tid, diagonal, seen, low, high), and for each row of df one with a null tid.

    seen holds the template's places that were met, as bits.
    The template side of the join is broadcast: its size is that of the fixed templates.
    """
    index = template_index(df.sparkSession, templates)
    met = document_grams(df, id_col, text_col).join(F.broadcast(index), "gram", "left")
    # The first gram of every text stays, matched or not, so that each row of df lives on.
    alive = met.filter(F.col("tid").isNotNull() | (F.coalesce("pos", F.lit(0)) == 0))
    once = F.when(F.col("tid").isNotNull(), F.col("pos") - F.col("at")).alias("diagonal")
    place = F.expr("shiftleft(1L, at)").alias("place")
    dealt = alive.select("uid", "id", "n_words", "tid", "pos", once, place).repartition("uid")
    return dealt.groupBy("uid", "id", "n_words", "tid", "diagonal").agg(
        F.bit_or("place").alias("seen"), F.min("pos").alias("low"), F.max("pos").alias("high")
    )


def scan(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: tuple[Template, ...] = TEMPLATES,
) -> DataFrame:
    """One row per input row: id, n_words, n_base, first_word, last_word, base_labels, labels, score, places.

    n_base counts the places of phrases, first_word and last_word are their smallest and largest start
    in words from 0, or null. labels holds base_labels and those of notices found; both are distinct,
    sorted and joined by commas, empty if there are none. score is the largest share of a template's
    grams at one place (1 for a phrase), 0 if no gram occurs. A span found by votes is verified by which
    grams of the notice it holds: COVERED of them, each counted once, and all that tell the license
    and its version from others. places lists (label, first, last, score)
    of what was found. A null text has no words; null or repeated ids and other columns change nothing.

    Votes are gathered per text, so a text with many places, or many texts with the same place, put no
    group on one task that is larger than one text.
    """
    sizes = F.array(*[F.lit(t.grams) for t in templates])
    needs = F.array(*[F.lit(t.needed).cast("bigint") for t in templates])
    names = F.array(*[F.lit(t.label) for t in templates])
    phrases = F.array(*[F.lit(t.phrase) for t in templates])
    votes = diagonals(df, id_col, text_col, templates)
    votes = votes.withColumns({"grams": F.get(sizes, F.col("tid")), "label": F.get(names, F.col("tid")), "phrase": F.get(phrases, F.col("tid")), "needed": F.get(needs, F.col("tid"))})
    along = Window.partitionBy("uid", "tid").orderBy("diagonal")
    near = F.col("diagonal") - F.lag("diagonal").over(along) <= DRIFT
    close = F.abs(F.col("low") - F.lag("low").over(along)) <= STRETCH * F.col("grams")
    joins = F.coalesce(near & close & ~F.col("phrase"), F.lit(False))
    runs = votes.withColumn("run", F.sum(F.when(joins, 0).otherwise(1)).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    merged = runs.groupBy("uid", "id", "n_words", "tid", "grams", "label", "phrase", "needed", "run").agg(
        F.bit_or("seen").alias("seen"), F.min("low").alias("first"), (F.max("high") + GRAM - 1).alias("last")
    )
    share = F.when(F.col("tid").isNotNull(), F.bit_count("seen") / F.col("grams"))
    told = F.col("seen").bitwiseAND(F.col("needed")) == F.col("needed")
    fits = F.col("last") - F.col("first") + 1 <= STRETCH * (F.col("grams") + GRAM - 1)
    good = F.when(F.col("phrase"), F.bit_count("seen") == F.col("grams")).otherwise((share >= COVERED) & fits & told)
    merged = merged.withColumns({"share": share, "good": F.coalesce(F.col("tid").isNotNull() & good, F.lit(False))})
    base = F.col("good") & F.col("phrase")

    def joined(condition):
        return F.array_join(F.sort_array(F.collect_set(F.when(condition, F.col("label")))), ",")

    start = F.when(base, F.col("first")).cast("bigint")
    place = F.struct("label", "first", "last", F.col("share").alias("score"))
    return merged.groupBy("uid", "id", "n_words").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(start).alias("first_word"),
        F.max(start).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("good")).alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
        F.sort_array(F.collect_list(F.when(F.col("good"), place))).alias("places"),
    ).drop("uid").withColumnRenamed("id", id_col)
