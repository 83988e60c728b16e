"""Fixed values of the reference corpus, and the profiles that put them together for a kind of book."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---- fixed values: patterns, word lists and limits that results depend on, as they are -------------

ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"
ASCII_DIGITS = "0123456789"
#: Marks deleted by the search normaliser, by the gate's normaliser, and before bracket numbers are read.
MARKS_SEARCH = r"[\u0610-\u061A\u064B-\u065F\u06D6-\u06ED\u0640\u0670]"
MARKS_GATE = r"[\u0610-\u061A\u064B-\u065F\u0670\u06D6-\u06ED\u0640]"
MARKS_BRACKET = r"[\u0610-\u061A\u064B-\u065F\u06D6-\u06ED\u0640]"
LETTERS_FROM, LETTERS_TO = "أإآٱىةؤئء", "اااايهوي"
GATE_LETTERS_FROM, GATE_LETTERS_TO = "أإآىة", "ااايه"
NOT_SEARCHABLE = r"[^\u0600-\u06FF0-9A-Za-z ]"
INVISIBLE = "\u200f\u200e\u00ad"
GLYPH_SPACE = "\uf141"

STOP_WORDS = """
حدثنا حدثني أخبرنا أخبرني أنبأنا نبأنا سمعت عن قال قالت يقول عليه وسلم صلى
رسول الله النبي رسوله قالوا قيل ذكر أول ثم كان يكون قد لا ما في من علي الي مع او
حتي كل هذا هذه ذلك الذي التي الذين هو هي هم انا انت نحن بن ابن بنت ابو ابي ام فقال فحدثنا
فأخبرنا لقد يا ايها انه انها مما الذي رضي سلامه صلاته
""".split()
NARRATION_STARTS = "حدثنا حدثني اخبرنا اخبرني انبانا انبا سمعت قال يذكر حدثه حدثت حدث قالت وعن وقال زعم بلغنا".split()
CHAPTER_STARTS = "كتاب باب فصل كتب خاتمة ترجمة الخاتمة مقدمة بسم".split()
AND = "و"

NUMBER_PREFIX = r"^\s*(\d{1,4})\s*(?:[-–—]\s*)?(.+)$"
UNIT_MARKER = r"^\s*الحديث\s*(\d{1,4})"
BRACKET_NUMBER = r"^\[([\d٠-٩]{1,4})\]$"
HEADER_NUMBER = r"^(\d{1,4})\s+(.*)$"
HEADER_REST = r"^(?:و\s*)?(?:حدثن[اي]|اخبرن[اي]|قال|سمعت)"
OPENING_FORMULA = r"^(?:و\s*)?(?:حدثن[اي]|اخبرن[اي]|انبانا)\s+.*\sعن\s"
CHAPTER_TITLE = r"^\s*كتاب\s+\S"
TITLE_STOP = "كتاب"
CROSS_REFERENCE = r"(?:ال)?حد[يبنث]+\s*[\d٠-٩]+\s*[-–—:]*\s*(?:أطرافه|طرفاه|أطراف)(?:\s*في)?\s*[:،]?\s*([\d٠-٩،,\s]+)"
LEAD_MARKER = r"^\[?[اال]حد[يبنث]+\s*[\d٠-٩]+[^\n]*\]?"
RULE_LINE = r"\n\s*ــ\s*\n"
RULE_PART = "ــ"
_MARKED = r"[\u0610-\u061A\u064B-\u065F\u0670\u0640]{0,2}"
GLUED_TAIL = rf'[٠١٢٣٤٥٦٧٨٩]{{0,4}}\s*[-–—]?\s*(ب{_MARKED}ا{_MARKED}ب{_MARKED}|ك{_MARKED}ت{_MARKED}ا{_MARKED}ب{_MARKED})\s+\S[^.؟!»"]{{0,90}}$'
STRAY_PREFIX = r"^\s*[،,]?\s*[٠١٢٣٤٥٦٧٨٩]{1,4}\s*[-–—]\s*\S"
FRAGMENT = r"[\(«]([^)»]{18,150})"
COMMENT_START = r"قَوْلُهُ|قوله"
NARRATION_FRAGMENT = r"^(?:حدثنا|اخبرنا|حدثني|اخبرني|سمعت|قال|عن|حدث|بال|وحدثنا|وعن|وقال|وهو|هو|ابن|بن)"

#: Greatest unit number of each base book, how many may be missing, and neighbours that may be identical.
UNIT_MAXIMA = {"bukhari": 7563, "muslim": 3033, "abudawud": 5274, "tirmidhi": 3956, "nasai": 5758, "ibnmajah": 4341, "malik": 1858, "bulugh_almaram": 1767}
UNIT_TOLERANCE = {"muslim": 13, "tirmidhi": 4, "ibnmajah": 1, "malik": 29}
IDENTICAL_ALLOWED = [(2201, 2202), (2724, 2725), (2788, 2789), (4240, 4241), (5709, 5710), (5710, 5711), (6073, 6074), (6074, 6075), (6835, 6836), (6859, 6860), (7102, 7103), (7103, 7104), (7105, 7106), (7106, 7107)]
UNORDERED_BOOKS = ("muslim",)

#: Accept rules: any row's bounds (best at least, ratio at least, margin over the second at least) all hold.
Rule = tuple[float, float, float]
NUMBERED_WINDOW: tuple[Rule, ...] = ((5, 0.55, 0), (6, 0, 4), (15, 0, 5), (6, 0.45, 2), (8, 0.6, 0))
RELAXED_FILL: tuple[Rule, ...] = ((8, 0.35, 0), (15, 0.25, 0))
MARKER_WINDOW: tuple[Rule, ...] = ((4, 0.35, 0), (3, 0.55, 0), (5, 0.25, 2), (10, 0, 3), (12, 0.25, 0))
MARKER_GLOBAL: tuple[Rule, ...] = ((5, 0.5, 0), (8, 0.35, 0), (4, 0.65, 0))
HEAD_ANCHOR: tuple[Rule, ...] = ((5, 0.35, 2),)

#: Moving windows, in list positions: how far behind and ahead of the pointer, what share of the top score (and which least score)
#: counts as tied with it, and how far the pointer may be from the proportional place.
NUMBERED_REACH = {"behind": 30, "ahead": 250, "tied": 0.88, "tied_least": 4}
PROPORTIONAL_REACH = {"behind": 30, "ahead": 400, "stray": 400}
#: Anchor search, in pages: behind the pointer, past the expected page at its most, and beyond it.
ANCHOR_REACH = {"behind": 2, "past": 10, "ahead": 12, "share": 15, "narrow": 12}
#: Words that decide on an anchor: of the opening to be looked for, on a page to confirm it; rare ones likewise.
ANCHOR_WORDS = {"opening": 5, "opening_confirms": 4, "rare": 2, "rare_confirms": 2}

# ---- profiles ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class PageProfile:
    """Where a page keeps its text. Containers are tried in turn; the first that is found counts."""

    container: str = r'(?s)<div class="nass[^"]*"[^>]*>(.*?)</div>\s*(?:<div|<section|<!--)'
    open_container: str | None = r'(?s)<div class="nass[^"]*"[^>]*>(.*)'
    open_end: str = "</section>"
    paragraph: str = r"(?s)<p>(.*?)</p>"
    run: str = r'(?s)<span class="(c\d+|special|anchor)"[^>]*>(.*?)</span>'
    plain_classes: tuple[str, ...] = ("anchor",)
    glue: str = ""
    challenge: str = "Just a moment"
    challenge_chars: int = 3000
    entities: dict[str, str] | None = None


ARTICLE_PAGES = PageProfile(
    container=r"(?s)<article>(.*?)</article>",
    open_container=None,
    entities={"&copy;": "©", "&middot;": "·", "&quot;": '"', "&lt;": "<", "&gt;": ">", "&amp;": "&"},
)
MENU_PAGES = PageProfile(container=r"(?s)<nav>(.*?)</nav>", open_container=None, paragraph=r"(?s)<li>(.*?)</li>", run=r'(?s)<a href="([^"]*)">(.*?)</a>', plain_classes=())


@dataclass(frozen=True)
class BookProfile:
    """How a commentary is cut and aligned. Limits are in characters or list positions."""

    slug: str
    book_id: int | None
    segmentation: str  # numbered, marker, marker_after, header, styled, formula, pages
    rules: tuple[Rule, ...] = MARKER_WINDOW
    least_text: int = 60
    most_text: int | None = None
    most_segment: int = 60_000
    head_chars: int = 500
    signature_chars: int = 2_000
    first_page: int = 1
    last_page: int | None = None
    extra: dict = field(default_factory=dict)


BOOKS = {
    b.slug: b
    for b in (
        BookProfile("bukhari", 1673, "numbered", NUMBERED_WINDOW, 40, first_page=494, last_page=7978),
        BookProfile("muslim", 1711, "pages", HEAD_ANCHOR, 250),
        BookProfile("nasai", 522, "marker", head_chars=400),
        BookProfile("abudawud", 5760, "marker", head_chars=400),
        BookProfile("ibnmajah", 9810, "header", head_chars=400),
        BookProfile("riyadh", 21543, "marker", head_chars=400),
        BookProfile("tirmidhi", None, "marker_after"),
        BookProfile("bulugh_almaram", 1082, "styled", most_text=60_000, last_page=2548),
        BookProfile("malik", 551, "formula", most_text=60_000, last_page=4156),
    )
}
