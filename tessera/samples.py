"""Patterns of a commentary, in which the queries dress the lines and pages of the tables, as those hold no such text themselves."""

from __future__ import annotations

_LONG = "حدثنا فلان بن فلان قال سمعت رجلا من اهل المدينة يذكر ذلك كثيرا جدا عن ابيه"
_TITLE = "هذا عنوان طويل بما يكفي ليكون رأسا لقسم"

#: (book_id, page, para_ix, runs as (class, text)); a paragraph's text is that of its runs.
PARAGRAPHS = [
    (1, 1, 0, [("", "ضائع قبل الاول")]),
    (1, 1, 1, [("", "1 حدثنا فلان بن فلان")]),
    (1, 1, 2, [("", "شرح الاول")]),
    (1, 1, 3, [("", "7 باب كذا")]),
    (1, 2, 0, [("c4", "[2]"), ("", "الثاني"), ("c2", " نص")]),
    (1, 2, 1, [("", "ذيل قبل "), ("c4", "[٣]"), ("", "الثالث بعد ")]),
    (1, 2, 2, [("", "ــ")]),
    (1, 3, 0, [("", "8 خاتمة كذا")]),
    (1, 3, 1, [("", "الحديث 9 كذا")]),
    (1, 3, 2, [("", "  ")]),
    (1, 3, 3, [("", "3 " + "نص " * 400)]),
    (2, 1, 0, [("c2", _TITLE), ("", " وباقي السطر")]),
    (2, 1, 1, [("", _LONG)]),
    (2, 1, 2, [("", "كلام اخر")]),
    (2, 2, 0, [("c2", "قصير"), ("", " نص")]),
    (2, 2, 1, [("", "12 وحدثنا رجل")]),
    (2, 2, 2, [("", "12 - قال الراوي")]),
    (2, 3, 0, [("", "12345 نص"), ("c4", "[12345]")]),
    (2, 3, 1, [("c4", "[77]")]),
    (2, 3, 2, [("", "الحديث 4 - أطرافه في: 6، 12")]),
]
NUMBER_LINES = ["12", "12345 foo", "7 باب كذا", "7 خاتمة كذا", "وباب اخر", "الحديث 15 نص", "الحديث ١٦ نص", "[٣]", " [12] ", "[12345]", "[x]", "13 حدثنا فلان", "13 نص", "14 و اخبرني فلان", "3 — نص", _LONG, "كتاب الصلاة", "كتاب", "قال رجل", "حدثنا فلان عن فلان", "", "  ", "١٢ - قال"]
COMMENTS = [
    ["[الحديث 5 - اطرافه في: 6، 7]\nنص الشرح", "", "  ", "ــ", "اخر"],
    ["اول\n  ــ \nثان", "ثالث"],
    ["", " \t "],
    ["الحديث ٩٩ كذا\nباق", "  طرف  "],
    ["نص فقط"],
]
#: (header, parts)
REFERENCES = [
    ("حدثنا", ["الحديث 5 - أطرافه في: 6، 7 ,٨", "نص"]),
    ("الحديث ٢٠ طرفاه في ٣٠ ٤٠", []),
    ("نص", ["نص", "نص", "حديث 1 أطرافه في 2"]),
    ("", ["حديث 3 أطراف: 9"]),
]
#: (book_id, page_ix, text)
TITLE_PAGES = [
    (1, 0, "كتاب الإيمان"), (1, 1, "نص (كتاب الإيمان) نص"), (1, 2, "x"), (1, 3, "كتاب"), (1, 4, "كتاب الإيمان\n[كتاب الصلاة]"),
    (1, 5, "(كتاب الصلاة)"), (1, 9, "كتاب الصلاة، "), (2, 0, "لا شيء"), (2, 1, "كتاب " + "طويل " * 20), (2, 2, "كتاب الزكاة"), (2, 3, "كتاب الصوم"), (2, 4, "كتاب الزكاة"),
]
#: What stands before and after a quoted text, and a quoted opening.
QUOTE_OWN, QUOTE_NEXT, QUOTE_NARRATION = ("مقدمة (ليست من الشرح في شيء ابدا) قوله (", ") ثم كلام"), ("قوله «", "» نقل"), "قوله (حدثنا رجل من اهل المدينة عن ابيه) فقط"
#: A container's beginning, its end in a page where another follows, and in one where none does; a challenge; plain marks and runs in their place.
CONTAINER, CLOSED, LEFT_OPEN, CHALLENGE = '<div class="nass margin-top-10" id="a">', '</div>\n<div class="next">', "</section>", "<title>Just a moment...</title>"
STYLES = [("<b>", '<span class="c2" x="1">'), ("</b>", "</span>"), ("<br>", "</span>"), ("<h1>", '<p><span class="anchor">7</span>'), ("</h1>", "</p>")]
#: Character references: named with and without a semicolon, unknown, numbered, out of range.
REFERENCES_IN_TEXT = ["&copy; &eacute;&Eacute", "&notit; &notin; &unknown; &", "&#65;&#x1F600;&#8364", "&#0; &#x80; &#150;", "&#55296; &#1114112; &#99999999999;", "&#1; &#xFFFE; &#x;", "&ampamp; &NotEqualTilde; &&lt"]
#: Chapters of each book, by their titles; the last one's is nowhere.
CHAPTERS = ["كتاب الإيمان", "كتاب الصلاة", "كتاب الزكاة", "كتاب الطهارة"]
