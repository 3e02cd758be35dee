"""Parameters of the cleaning, extraction and freshness operators.

Site-specific wording is data, not code: every operator takes these values as
arguments and the module only supplies neutral defaults.
"""

# Whitespace as Python's str.strip() sees it; Java's \s is ASCII-only.
PY_WS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# spelled as escapes: Spark reads a pattern anew for each text, and ASCII is read fastest
_WS_BODY = r"\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WS = rf"[\s{_WS_BODY}]"
# the same class without the line feed, for patterns that must stay on one line
HS = rf"[ \t\x0b\x0c\r{_WS_BODY}]"

SOURCE_ID = "example-website"
SOURCE_TYPE = "website"

CONTENT_TYPES = (
    "blog-post",
    "event",
    "party-information",
    "pdf-document",
    "policy",
    "team-member",
)

# --- fixed values: metadata grammar of the raw markdown --------------------
META_FIELDS = (
    "Title", "Date", "Author", "Location", "URL", "Scraped",
    "When", "Venue", "Address", "Role", "Electorate",
)
QUOTE_FIELDS = ("URL", "Scraped")
FOOTER_MARKERS = (r"###\s*Check out more policies", r"##\s*Get Involved")
PDF_HEADER_FIELDS = ("Date", "Policy", "Document Type")
PDF_TABLE_SKIP = ("Field", "------", "-----")
CONTENTS_COMMENT = (
    "<!-- The Contents (TOC) table has been removed during transformation; "
    "the rendered document provides its own navigation. -->\n\n"
)
DETAIL_HEADING = "## Full Policy Detail"

# --- fixed values: snapshot freshness in seconds ---------------------------
CATEGORY_TTL = {
    "policies": 86_400,
    "team": 86_400,
    "party-info": 86_400,
    "blog": 21_600,
    "events": 7_200,
}
DEFAULT_TTL = 43_200

# --- fixed values: extraction ----------------------------------------------
BOILERPLATE_TAGS = ("script", "style", "nav", "footer", "header")
SUBLINK_KEYWORDS = ("constitution", "governance", "registration", "rules")
ROLE_LADDER = (
    ("party leader", "Party Leader"),
    ("deputy leader", "Deputy Leader"),
    ("candidate", "Candidate"),
)
DEFAULT_ROLE = "Candidate"
LEADER_ROLE, DEPUTY_ROLE = "Party Leader", "Deputy Leader"
NOT_ELECTORATES = ("media contact", "donate")
MONTH_PREFIX = r"(?i)^(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
FILE_HOST = "drive.google.com"

# brand wording stripped from PDF pages and file names: supply your own
PAGE_FOOTERS = (r"^Example\s+Org\b", r"Rules of Example Org\s*\|")
FILENAME_PREFIXES = ("Brand_", "Policy_")

# --- fixed values: validation ----------------------------------------------
COVERAGE_THRESHOLD = 0.95
HEADING_MIN_WORDS = 500
FRESH_DAYS = 7

# --- fixed values: words broken by dropped ligatures, in order -------------
LIGATURES = (
    ("ElectorateCandidate", "Electorate Candidate"),
    ("Commiees", "Committees"),
    ("commiees", "committees"),
    ("Commiee", "Committee"),
    ("commiee", "committee"),
    ("Oicers", "Officers"),
    ("Wrien", "Written"),
    ("oicers", "officers"),
    ("maers", "matters"),
    ("eective", "effective"),
    ("eectiveness", "effectiveness"),
    ("eects", "effects"),
    ("leers", "letters"),
    ("aairs", "affairs"),
    ("leer (from|would|was|of|to|that)", "letter $1"),
    ("oicer", "officer"),
    ("oicio", "officio"),
    ("oice", "office"),
    ("maer", "matter"),
    ("eect", "effect"),
    ("wrien", "written"),
    ("aair", "affair"),
    ("suered", "suffered"),
    ("oence", "offence"),
    ("Eicacy", "Efficacy"),
    ("ciency", "efficiency"),
    ("laer", "latter"),
    ("siing", "sitting"),
    ("ainment", "attainment"),
    ("erent", "different"),
    ("regardinga", "regarding a"),
)

# --- fixed values: per-document repairs ------------------------------------
PROBLEM_WRAPPER = "The problems we’re solving"
FAQ_WRAPPER = "Frequently Asked Questions"
SPLIT_HEADINGS = (
    (
        "What does the Land Value Tax mean for ‘asset-rich, cash-poor’ Kiwis like",
        "retirees or farmers?",
    ),
    (
        "What was your process in designing the Tax Reset. Have independent",
        "economists reviewed this?",
    ),
    (
        "What about Temporary Residents and Workers. Increasing tax rates without a",
        "Citizen’s Income will dramatically raise their tax bill.",
    ),
)
PROMOTED_HEADINGS = (
    "1.3 Install cameras and maintain observers on all commercial fishing vessels",
    "4.3 Develop long-term regional ocean plans in partnership with communities",
)
RUNNING_LABELS = ("Oceans", "Energy", "Direct Democracy")
DUPLICATE_HEADER = "Policy Addendum"
ORPHAN_PARAGRAPH = "desirability of a pan-sector vision"
DECORATIVE_PICTURES = ("Making zero<br>the hero", "le R<br>k<br>e<br>R<br>c")
