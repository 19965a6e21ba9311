"""Records cut off by field limits: prefix self-joins, checked against how the text ends.

Values are put into one sorted order; a value is a strict prefix of a longer one exactly if it is a prefix of the next
different value, so one range-partitioned sort finds all of them and no pair is ever emitted. This is done twice: over whole
texts (a longer copy elsewhere proves a cut) and over words (a last word that is rare beside a longer word of the corpus that it
begins was cut in the middle; texts that were collected again count once). A strict prefix is truncated, whatever it looks like. Most cut
documents have no longer copy, so the method alone cannot find them: the form of the last sentence, list entry, code line or table row decides,
and where the form leaves it open, the joins and what the corpus shows decide: texts written without stops, a sentence a line, are judged by
how often their last word ends a sentence elsewhere.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

COMPLETE, BARE, STOPLESS, CUT = "complete", "bare", "stopless", "cut"
#: A last word was cut if one that it begins is in more than so many times as many texts.
RARER = 20
#: In a text without stops, a last word that ends a sentence in fewer than one of so many of the texts that hold it was not the last.
ENDS = 50
#: No line that was wrapped is longer.
WRAPPED = 100

_MARK = re.compile(r"(?:\[\s*(?:\.\.\.|…)\s*\]|\.\.\.|…|\((?:more|continued|cont\.?)\)|\[truncated\]|\bread more)\s*$", re.IGNORECASE)
_ANNOUNCED = re.compile(r"\b(?:next|following|later|another)\s+(?:chapter|section|part|post|page|release|article|episode)s?\W*$", re.IGNORECASE)
_ENTITY = re.compile(r"&#?\w{0,8}$")
_STOP = re.compile(r"[.!?。！？।][)\]}\"'”’»*_`」』）]*$")
_ASIDE = re.compile(r"[.!?。]\s+[\[(][^()\[\]]*[\])]$")
_SIGN_OFF = re.compile(r"^(?:--|[a-z ]*\b(?:thanks|thank you|regards|cheers|greetings|best|yours|bye))\W*$", re.IGNORECASE)
_NAME = re.compile(r"^[A-Za-z][\w.]*(?: [A-Z][\w.]*){0,3}$")
_LABEL = re.compile(r"^[A-Z][\w-]*(?: \w+){0,2}: \S")
_NUMBERED = re.compile(r"^[A-Z]\w*(?: \w+){1,4} \d+$")
_URL = re.compile(r"^(?:[A-Z]\w*:? )?(?:https?|ftp)://[^\s/]+\.\w+/\S+$")
_ITEM = re.compile(r"^\s*(?:[-*+•]|\d{1,3}[.)])\s+(.*)$")
_CODE = re.compile(r"^\s*(?:static|extern|const|unsigned|int|long|char|void|bool|double|return|typedef|struct|enum|#\w+|[A-Z]{2,}\s).*[;{}]$")
_SETTING = re.compile(r"^\s{2,}[\w.]+\s*[=:]\s*\S+$")
_QUOTE = re.compile(r"^[ \t]*(?:>[ \t]?)+")
_WORDS = re.compile(r"\w+")
_ENDED = re.compile(r"\b(\w++)[`\"')\]]*+[.!?](?=\s|$)")
_LOWER = re.compile(r"[`\"(]*[a-z]|`")


def without_stops(body: str) -> bool:
    """Whether the last paragraph has a sentence a line and no stop: every line begins in lower case, none ends in a stop, and a line goes on
    only where it could not have been wrapped: it is longer than WRAPPED, or the next line's first word had room."""
    lines = [x.strip() for x in body[body.rfind("\n\n") + 1 :].strip().split("\n")]
    if any(not _LOWER.match(x) for x in lines) or any(_STOP.search(x) for x in lines[:-1]):
        return False
    if re.search(r"[.!?]\s+[A-Z]", lines[-1]):
        return False
    width = max(map(len, lines))
    return all(len(x) > WRAPPED or len(x) + 1 + len(y.split(" ")[0]) <= width for x, y in zip(lines, lines[1:])) and (len(lines) > 1 or len(lines[0]) > WRAPPED)


def last_word(text: str) -> str:
    """The last word in lower case, empty if there is none."""
    end = len(text)
    while end and not (text[end - 1].isalnum() or text[end - 1] == "_"):
        end -= 1
    begin = end
    while begin and (text[begin - 1].isalnum() or text[begin - 1] == "_"):
        begin -= 1
    return text[begin:end].lower()


def ending(text: str | None) -> tuple[str, str]:
    """(state, last word): whether the text's last unit is complete, cut, bare (a unit that needs no stop and shows no cut) or stopless (of a
    text written without stops)."""
    if not text or not text.strip():
        return COMPLETE, ""
    body = text.rstrip()
    lines = body.split("\n")
    line = _QUOTE.sub("", lines[-1]).rstrip()
    before = lines[-2].strip() if len(lines) > 1 else ""
    last = last_word(body)
    mark = _MARK.search(body)
    if mark:
        return (COMPLETE if _ANNOUNCED.search(body[: mark.start()]) else CUT), last
    if body.count("```") % 2:
        return CUT, last
    if body.endswith("```") or body.endswith("*/"):
        return COMPLETE, last
    if line.startswith("|"):
        cells = before.count("|") if before.startswith("|") else line.count("|")
        return (COMPLETE if line.endswith("|") and line.count("|") == cells else CUT), last
    if _SIGN_OFF.match(line) or _SIGN_OFF.match(before) and _NAME.match(line):
        return COMPLETE, last
    if _STOP.search(line) or body[-1] in ")]" and _ASIDE.search(body):
        return COMPLETE, last
    if _ENTITY.search(line):
        return CUT, last
    if _CODE.match(line) or _SETTING.match(lines[-1]) or _URL.match(line):
        return COMPLETE, last
    alone = not before
    if alone and _NUMBERED.match(line):
        return COMPLETE, last
    item = _ITEM.match(line)
    if item:
        others = [m.group(1).rstrip() for x in lines[:-1] if (m := _ITEM.match(x))]
        plain = [o for o in others if o and not _STOP.search(o)]
        if text != body and text[-1] in " \t":
            return CUT, last
        if item.group(1)[:1].isupper() and not plain or len(item.group(1).split()) > 12:
            return CUT, last
        return BARE, last
    if alone and _LABEL.match(line) and len(line) <= 80 and not text.endswith((" ", ",")):
        return BARE, last
    if len(lines) == 1 and len(line.split()) <= 8 and line[:1].isupper() and not text.endswith((" ", ",")) and not re.search(r"[.!?`]", line):
        return BARE, last  # a title
    return STOPLESS if without_stops(body) and body == text else CUT, last


def strict_prefixes(values: DataFrame, value: str) -> DataFrame:
    """(value, longer): each distinct non-empty value that is a strict prefix of another, with the next such value in order.

    Null and empty values take no part; equal values are one. One range-partitioned sort; values that end a partition are compared with
    the next partition's first through a table of two rows a partition.
    """
    v = values.select(F.col(value).cast("string").alias("v")).filter("v IS NOT NULL AND v <> ''").distinct()
    ordered = v.repartitionByRange("v").sortWithinPartitions("v").withColumn("p", F.spark_partition_id())

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, part = None, 0
        for pdf in it:
            rows = []
            for x, p in zip(pdf["v"], pdf["p"]):
                part = int(p)
                if held is None:
                    rows.append((x, None, part, 0))
                elif x.startswith(held):
                    rows.append((held, x, part, None))
                held = x
            yield pd.DataFrame(rows, columns=["v", "longer", "p", "edge"]).astype({"edge": "Int64"})
        if held is not None:
            yield pd.DataFrame([(held, None, part, 1)], columns=["v", "longer", "p", "edge"])

    found = materialize(ordered.mapInPandas(run, "v string, longer string, p int, edge int"), "prefixes")
    nxt = F.lead("v").over(Window.partitionBy().orderBy("p", "edge"))  # two rows a partition
    edges = found.filter("edge IS NOT NULL").withColumn("longer", nxt).filter("edge = 1 AND longer <> v AND startswith(longer, v)")
    return found.filter("edge IS NULL").select("v", "longer").unionByName(edges.select("v", "longer"))


def cut_words(words: DataFrame, last: DataFrame) -> DataFrame:
    """w: the words of `last` (w) that are strict prefixes of words (w, n: texts that hold it), one of them in over RARER times as many
    texts as hold w, not counting one, the text that is judged.

    The longer words are found by exploding the vocabulary's prefixes, kept only where they are prefixes to be judged.
    """
    short = strict_prefixes(words, "w").select(F.col("v").alias("w")).join(last.distinct(), "w", "left_semi").join(words, "w")
    begins = F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda k: F.substring("w", F.lit(1), k))
    longer = words.filter(F.length("w") > 1).select(F.explode(begins).alias("w"), F.col("n").alias("longer")).join(short.select("w"), "w", "left_semi").groupBy("w").agg(F.max("longer").alias("longer"))
    return short.join(longer, "w").filter((F.col("n") - 1) * RARER < F.col("longer")).select("w")


def truncation_evidence(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, state, has_longer_copy, word_cut, truncated; one row per input row with a non-null id.

    truncated: a longer copy goes on behind it; or the last unit is cut; or it is bare and its last word is a fragment; or it is stopless and its
    last word is a fragment or hardly ever ends a sentence. Null and blank texts are not truncated. Text is compared whole, in lower case with runs of white space as one space. Repeated rows
    get equal rows; extra columns are not read.
    """
    d = documents.select(F.col(doc_id).alias("_d"), F.col(source).cast("string").alias("_s"), F.col(text).cast("string").alias("_t")).filter("_d IS NOT NULL")
    d_type = documents.schema[doc_id].dataType.simpleString()

    def judge(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            e = [ending(t) for t in pdf["_t"]]
            norm = [" ".join(_MARK.sub("", t).lower().split()) if t else None for t in pdf["_t"]]
            yield pd.DataFrame({"_d": pdf["_d"], "_s": pdf["_s"], "state": [x[0] for x in e], "_w": [x[1] for x in e], "_n": norm})

    def vocabulary(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, e = Counter(), Counter()
        for pdf in it:
            for t in pdf["_n"]:
                n.update(set(_WORDS.findall(t)))
                e.update(set(_ENDED.findall(t)))
            if len(n) > 200_000:
                yield pd.DataFrame({"w": list(n), "n": list(n.values()), "e": [e[w] for w in n]})
                n.clear()
                e.clear()
        yield pd.DataFrame({"w": list(n), "n": list(n.values()), "e": [e[w] for w in n]})

    judged = materialize(d.mapInPandas(judge, f"_d {d_type}, _s string, state string, _w string, _n string").withColumn("_h", F.when(F.coalesce("_n", F.lit("")) != "", F.md5("_n"))), "truncation")
    copies = strict_prefixes(judged, "_n").select(F.md5("v").alias("_h")).withColumn("has_longer_copy", F.lit(True))
    texts = judged.select("_n").filter("_n IS NOT NULL").distinct()
    words = materialize(texts.mapInPandas(vocabulary, "w string, n bigint, e bigint").groupBy("w").agg(F.sum("n").alias("n"), F.sum("e").alias("e")), "truncation-words")
    # Only rows that the form leaves open need their last word's evidence.
    asked = judged.filter(F.col("state").isin(BARE, STOPLESS)).select(F.col("_w").alias("w")).distinct()
    fragments = cut_words(words.select("w", "n"), asked).select("w", F.lit(True).alias("word_cut"))
    told = asked.join(words, "w", "left").join(fragments, "w", "left").select(F.col("w").alias("_w"), F.coalesce("word_cut", F.lit(False)).alias("word_cut"), (F.coalesce("e", F.lit(0)) * ENDS < F.coalesce("n", F.lit(1))).alias("_inner"))
    open_ = judged.filter(F.col("state").isin(BARE, STOPLESS)).join(told, "_w").drop("_w")
    out = judged.filter(~F.col("state").isin(BARE, STOPLESS)).drop("_w").withColumns({"word_cut": F.lit(False), "_inner": F.lit(False)}).unionByName(open_)
    out = out.join(copies, "_h", "left").fillna(False, ["has_longer_copy"])
    bad = F.col("has_longer_copy") | (F.col("state") == CUT) | (F.col("state").isin(BARE, STOPLESS) & F.col("word_cut")) | ((F.col("state") == STOPLESS) & F.col("_inner"))
    return out.select(F.col("_d").alias("doc_id"), F.col("_s").alias("source"), "state", "has_longer_copy", "word_cut", bad.alias("truncated"))


def truncation_rates(evidence: DataFrame) -> DataFrame:
    """source, n_docs, n_truncated, share; documents of a null source are one row."""
    n = F.sum(F.col("truncated").cast("bigint"))
    return evidence.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), n.alias("n_truncated"), (n / F.count(F.lit(1))).alias("share"))
