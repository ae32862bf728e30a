"""Licence texts found by canonical digest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spellings that licence matching guidelines hold to be the same word, each after its canonical one.
SPELLINGS = {
    "acknowledgment": ["acknowledgement"], "analog": ["analogue"], "analyze": ["analyse"], "artifact": ["artefact"],
    "authorization": ["authorisation"], "authorized": ["authorised"], "caliber": ["calibre"], "canceled": ["cancelled"],
    "capitalizations": ["capitalisations"], "catalog": ["catalogue"], "categorize": ["categorise"], "center": ["centre"],
    "copyright owner": ["copyright holder"], "emphasized": ["emphasised"], "favor": ["favour"], "favorite": ["favourite"],
    "fulfill": ["fulfil"], "fulfillment": ["fulfilment"], "https": ["http"], "initialize": ["initialise"],
    "judgment": ["judgement"], "labeling": ["labelling"], "labor": ["labour"], "license": ["licence"],
    "maximize": ["maximise"], "modeled": ["modelled"], "modeling": ["modelling"], "noncommercial": ["non commercial"],
    "offense": ["offence"], "optimize": ["optimise"], "organization": ["organisation"], "organize": ["organise"],
    "percent": ["per cent"], "practice": ["practise"], "program": ["programme"], "realize": ["realise"],
    "recognize": ["recognise"], "signaling": ["signalling"], "sublicense": ["sub license", "sub licence"],
    "utilization": ["utilisation"], "while": ["whilst"], "wilfull": ["wilful"],
}


#: What may stand between the words of a statement: blanks, line ends and the marks that comments put before lines.
_GAP = r"[\s*#/:,-]*"
_SIGN = r"(?:©|&copy;|\(c\))"
_YEAR = r"(?:(?:19|20)\d\d\b|[<\[{(]\s*(?:yyyy|years?|dates?)\b)"
#: Words after ``copyright`` that are no holder.
_NO_HOLDER = (
    "notices?|holders?|owners?|owned|ownership|laws?|statements?|licen[cs]es?|licensors?|licensed|interests?|protections?|protected|acts?|infringements?|rights?|claims?|"
    "dates?|years?|information|info|lines?|disclaimers?|terms?|treaty|treaties|legends?|markings?|marks?|materials?|works?|files?|headers?|management|grants?|permissions?|"
    "status|exceptions?|policy|policies|doctrines?|office|subsists|and|or|is|in|of|to|for|as|on|under|if|may|shall|must|will|can|not|has|have|with|which|that|are|was|be|from|at|this|these|any|all"
)
#: A statement starts with ``copyright`` or the sign and a sign or year; ``(c)`` alone needs the year, since it also numbers
#: clauses. A holder without both follows the sign, or a capital ``Copyright`` that starts a line.
_START = (
    rf"(?:(?i:\bcopyright\b{_GAP}(?:by\b{_GAP})?(?:{_SIGN}|{_YEAR})|{_SIGN}{_GAP}copyright\b(?!\s+(?:{_NO_HOLDER})\b)|\(c\){_GAP}{_YEAR}|(?:©|&copy;)[\x20\x09]*(?=[\p{{L}}\p{{N}}<\[]))"
    rf"|(?<=^[\x20\x09*#/;-]{{0,40}})(?:Copyright|COPYRIGHT)\b:?[\x20\x09]+(?:by[\x20\x09]+)?(?=\p{{Lu}})(?!(?i:{_NO_HOLDER})\b))"
)
#: Words that start a licence, so they end a statement that has no full stop before them.
_OPENER = (
    r"(?:all\s+rights\s+reserved|permission\s+(?:is|to)|permission,|redistributions?\s+(?:and|of|in)|licensed\s+under|released\s+under|distributed\s+under|everyone\s+is|anyone\s+(?:is|may)|"
    r"you\s+(?:may|can|are)|this\s+\w+|the\s+(?:above|software|following|authors?\s+\w*\s*grant)|use\s+of\s+this|use,\s+\w+|subject\s+to|under\s+the\s+terms|provided\s+)"
)
#: A full stop that ends a statement: not that of an initial or title, nor of ``Inc.`` and the like with more holders behind.
_STOP = r"(?<!\b\p{L})(?<!\b(?:dr|mr|ms|mrs|st|prof))[.;](?=\s|$)(?<!\b(?:inc|ltd|corp|co|llc|jr|sr|bros|al)\.(?=\s+(?:and|or|et|kg)\b|\s*[,&<(]))"
_LINE_END = r"(?<!,)(?<!\band)(?<!&)[\x20\x09\r]*\n(?![\x20\x09*#/;-]*(?:and\b|&))"
STATEMENT = (
    rf"(?m)(?=[cC©&(]){_START}(?i:(?:(?!{_STOP}|{_LINE_END}|\b{_OPENER}|\bcopyright\b{_GAP}(?:{_SIGN}|{_YEAR})|{_SIGN}{_GAP}{_YEAR})[\s\S])*+"
    rf"[.;]?(?:[\s*#/;,-]*all\s+rights\s+reserved\b\.?)?)"
)


def canonical(text: Column) -> Column:
    """Text without copyright statements, in lower case, words apart by one blank, equivalent spellings made one.

    A statement is ``copyright`` or its sign with a year or holder, wherever it stands. It ends with its line, unless that
    breaks at a comma or ``and``; before that with its sentence or where a licence starts. ``All rights reserved`` behind
    it is part of it. What follows on the line stays, and so do the copyright notice, holder, law and the like, however the
    text is wrapped. Everything but letters and digits parts words. Null stays null.
    """
    low = F.lower(text)
    signed = reduce(lambda a, b: a | b, [low.contains(sign) for sign in ("copyright", "©", "&copy;", "(c)")])  # most texts need no search
    plain = F.when(signed, F.lower(F.regexp_replace(text, STATEMENT, " "))).otherwise(low)
    plain = F.concat(F.lit(" "), F.trim(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    variants = [(v, word) for word, others in SPELLINGS.items() for v in others]
    replaced = reduce(lambda found, v: F.replace(found, F.lit(f" {v[0]} "), F.lit(f" {v[1]} ")), variants, plain)
    any_variant = " (?:" + "|".join(v for v, _ in variants) + ") "
    return F.when(plain.rlike(any_variant), replaced).otherwise(plain)


def license_digest(text: Column) -> Column:
    """SHA-256 of the canonical text; null for null and for a text without a word left."""
    plain = canonical(text)
    return F.when(F.trim(plain) != "", F.sha2(plain, 256))


def license_matches(texts: DataFrame, licenses: DataFrame, id_col: str = "doc_id", text_col: str = "text", license_col: str = "license_id", license_text: str = "text") -> DataFrame:
    """``id_col`` and ``license_col`` of every text that is, as a whole, a known licence.

    Texts and licences meet by digest only. Licences with one digest are one: the smallest id stands for them, so a text
    matches once. Repeated texts get a row each; nulls, empty texts and texts of nothing but copyright statements match nothing;
    other columns are ignored. A text so frequent that it fills tasks is split by adaptive skew handling.
    """
    known = licenses.select(F.col(license_col).alias("__license"), license_digest(F.col(license_text)).alias("__digest"))
    known = known.where(F.col("__digest").isNotNull() & F.col("__license").isNotNull()).groupBy("__digest").agg(F.min("__license").alias("__license"))
    digests = texts.select(F.col(id_col).alias("__id"), license_digest(F.col(text_col)).alias("__digest")).where(F.col("__digest").isNotNull())
    return digests.join(known, "__digest").select(F.col("__id").alias(id_col), F.col("__license").alias(license_col))
