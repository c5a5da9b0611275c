"""Invented publication records covering the edge cases of FIXTURES.md (A).

All names, titles and identifiers are made up for these tests."""

from __future__ import annotations

import json


def title(n: int, stem: str = "A study of ") -> str:
    s = (stem + "x" * n)[:n]
    assert len(s) == n
    return s


def v(*created: str) -> list[dict]:
    return [{"version": f"v{i + 1}", "created": c} for i, c in enumerate(created)]


T3 = ("Mon, 15 Jan 2007 10:00:00 GMT", "Tue, 2 Jan 2007 09:30:00 GMT", "Wed, 7 Feb 2007 23:59:59 GMT")


def rec(title_, submitter, authors_parsed, doi, versions=None, comments="c", authors="x", categories="cs.DB"):
    return {
        "id": "orig-id", "submitter": submitter, "authors": authors, "title": title_, "comments": comments,
        "journal-ref": None, "doi": doi, "report-no": None, "categories": categories,
        "abstract": "abstract text", "license": None, "update_date": "2020-01-01",
        "versions": versions if versions is not None else v("Thu, 1 Mar 2007 12:00:00 GMT"),
        "authors_parsed": authors_parsed,
    }


PUBLICATIONS = {
    "0": rec(title(34), "John Smith", [["Smith", "John"]], "10.9/a0"),                       # too short
    "1": rec(title(35), "John Smith", [["Smith", "John", ""]], "10.9/a1", v(*T3)),           # trailing blank
    "2": rec(title(36), "Wei Liu", [["Liu", "Wei"], ["Li", "Wei"]], "10.9/a2"),             # Li after Liu
    "3": rec(None, "Wei Liu", [["Liu", "Wei"]], "10.9/a3"),                                 # null title
    "4": rec(title(40, "Symbols \U0001D518 in "), "A. O'Neil", [["O'Neil", "A."]], "10.9/a4"),  # 4-byte char, dot
    "5": rec(title(50, "Duplicate "), "Sam Lee", [["Lee", "Sam"]], "10.9/dup", v("Fri, 2 Mar 2007 12:00:00 GMT")),
    "6": rec(title(50, "Duplicate "), "Sam Lee", [["Lee", "S."]], "10.9/dup", v("Sat, 3 Mar 2007 12:00:00 GMT")),
    "7": rec(title(45, "Null pair "), "Sam Lee", [["Lee", "Sam"]], None, comments=None),
    "8": rec(title(45, "Null pair "), "Sam Lee", [["Lee", "Sam"]], None, v(), comments=None),
    "9": rec(title(44, "Doi none "), "Sam Lee", [["Lee", "Sam"]], "None"),                  # 'None' doi
    "10": rec(title(44, "Missing doi "), "Maria Garcia", [["Garcia"]], "10.9/missing", comments="None"),
    "11": rec(title(44, "Escapes "), "Pat Brown", [["Brown", "", ""], ['M\\"uller', "Anna"]], "10.9/a11",
              v("Sun, 4 Mar 2007 12:00:00 GMT", "Someday, 99 Foo 2007 00:00:00 GMT")),       # bad date
    "12": rec(title(44, "Repeated "), "John Smith", [["Smith", "John", ""], ["Smith", "John", ""]], "10.9/a12"),
    "13": rec(title(44, "Initial "), "J. Smith", [["Doe", "Jane"]], "10.9/a13", v()),       # empty versions
    "14": rec(title(44, "No match "), "Kim Nobody", [["Park", "Kim"]], "10.9/a14"),
    "15": rec(title(44, "Null gender "), "Alex Doe", [["Doe", "Alex"]], "10.9/a15"),
    # same as each other except categories: not duplicates, both stay
    "16": rec(title(46, "Categories "), "Sam Lee", [["Lee", "Sam"]], "10.9/a16", categories="math.CO"),
    "17": rec(title(46, "Categories "), "Sam Lee", [["Lee", "Sam"]], "10.9/a16", categories="math.PR"),
    "18": rec(title(44, "Null doi "), "Sam Lee", [["Lee", "Sam"]], None),                  # raw null doi
    "19": rec(title(44, "No lookup row "), "Zed Doe", [["Doe", "Zed"]], "10.9/a19"),    # first name not in lookup
}

# doi -> (reference_count, discipline list, publication_type, journal)
LONG_JOURNAL = "Journal of Extremely Long Names for Testing Column Limits"
DOI_LOOKUP = [
    ("10.9/a1", 5, ["Physics", "Math"], "journal-article", "Alpha Press"),
    ("10.9/a2", 10, ["Math"], "journal-article", "Beta Press"),
    ("10.9/a4", 10, [], "proceedings", None),
    ("10.9/a11", 7, None, "journal-article", "Alpha Press"),
    ("10.9/a12", 3, None, "book", LONG_JOURNAL),
    ("10.9/a13", 1, ["Biology"], "journal-article", "Alpha Press"),
    ("10.9/a14", 2, ["Math"], "proceedings", "Beta Press"),
    ("10.9/a15", None, ["Physics"], "journal-article", "Beta Press"),
]

GENDER_LOOKUP = [("John", "male"), ("Wei", "female"), ("Maria", "female"), ("Pat", "unknown"), ("Kim", None),
                 ("Alex", None), ("Sam", "male")]


def write_indexed_json(path: str) -> str:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(PUBLICATIONS, f, ensure_ascii=False)
    return path


def doi_lookup(spark):
    from bibliospark.schemas import DOI_LOOKUP as S
    return spark.createDataFrame(DOI_LOOKUP, S)


def gender_lookup(spark):
    from bibliospark.schemas import GENDER_LOOKUP as S
    return spark.createDataFrame(GENDER_LOOKUP, S)
