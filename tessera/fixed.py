"""Fixed values that results depend on.

FIXED VALUES — these must stay exactly as written (same text, same order) for
the outputs to equal the original analysis: the category/term taxonomy, the
boilerplate phrases, the character classes of the two text cleaners, the
script-ratio thresholds, the crawl budget and the raster constants.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: category -> terms taxonomy (4 categories, 61 entries, 60
# distinct terms: "crypto" is listed in two categories).
# ---------------------------------------------------------------------------
TAXONOMY: dict[str, list[str]] = {
    "Παροχή Επενδυτικών Υπηρεσιών και Υπηρεσιών σε κρυπτοστοιχεία": [
        "επένδυση", "επενδυτική", "κρυπτο", "crypto",
        "κεφάλαιο", "διαχείριση", "χαρτοφυλάκιο",
        "απόδοση", "αποδόσεις", "συμβουλή",
        "ρίσκο", "μετοχη", "ομόλογα", "fund", "ETF", "broker",
        "investment", "portfolio", "asset", "market", "analysis",
        "financial", "equity", "securities", "derivatives",
    ],
    "Red flags και φράσεις πίεσης": [
        "μόνο.*σήμερα", "limited time", "προσφορά",
        "επενδύστε τώρα", "buy now", "άμεσα", "επείγον",
        "υψηλό κέρδος", "100% εγγυημένο", "χωρίς ρίσκο",
        "guaranteed return", "risk-free", "get rich",
        "γρήγορο κέρδος", "σίγουρο κέρδος",
    ],
    "Κρυπτο-υπηρεσίες": [
        "crypto", "token", "ICO", "exchange", "mining",
        "bitcoin", "ethereum", "altcoin", "blockchain",
        "NFT", "wallet", "metaverse",
        "ψηφιακό νόμισμα", "ψηφιακο", "κρυπτονομισμα",
    ],
    "Έμμεσοι Δείκτες": [
        "πληρωμές μόνο με κρυπτονομίσματα",
        "απαγορεύονται οι τραπεζικές συναλλαγές",
        "αποφυγή τραπεζικού συστήματος",
        "ανώνυμοι διαχειριστές ή συντονιστές",
        "Μη αναφορά σε στοιχεία επικοινωνίας ή επίσημη έδρα",
        "Ασυνεπείς όροι σε διαφορετικές σελίδες (FAQ vs Terms) - δείχνει προσωρινότητα / copy-paste.",
    ],
}

# FIXED VALUES: the expanded keyword list (prose only in the original, never
# wired into its counting); available as extra taxonomy rows on request.
EXPANDED_TAXONOMY: dict[str, list[str]] = {
    "Suspicious Price Movements": [
        "αιφνίδια άνοδος", "αιφνίδια πτώση", "ξαφνική μεταβολή", "έντονη διακύμανση",
        "μεταβλητότητα αγοράς", "απότομη διόρθωση", "έντονο ανοδικό ράλι",
        "ξεπούλημα μετοχών", "απότομη ξεπούλημα", "σπασμωδικές κινήσεις",
        "υπέρμετρη άνοδος", "υπέρμετρη πτώση", "αδικαιολόγητη μεταβολή",
        "μη φυσιολογική κίνηση", "ασυνήθιστη μεταβλητότητα",
    ],
    "Insider Trading / Information Leaks": [
        "διαρροή πληροφοριών", "εμπιστευτικές πληροφορίες", "προνομιακή ενημέρωση",
        "εσωτερική πληροφόρηση", "ύποπτη συναλλαγή πριν την ανακοίνωση",
        "συναλλαγές πριν τη δημοσίευση", "συναλλαγές με προνομιακά δεδομένα",
        "εσωτερική εκμετάλλευση", "ύποπτη συμπεριφορά μετόχου",
        "ανεξήγητη δραστηριότητα πριν τα νέα",
    ],
    "Market Manipulation Tactics": [
        "τεχνητός όγκος", "τεχνητή ζήτηση", "τεχνητή προσφορά", "χειραγώγηση τιμής",
        "pump and dump", "wash trading", "spoofing", "layering", "market cornering",
        "trade-based manipulation", "quote stuffing", "πλασματικές εντολές",
        "πλασματικός όγκος",
    ],
    "Regulatory / Legal Alerts": [
        "παρέμβαση της επιτροπής κεφαλαιαγοράς", "ρυθμιστική προειδοποίηση",
        "έρευνα αγοράς", "έλεγχος συναλλαγών", "ανακοίνωση εποπτικής αρχής",
        "παράβαση κανόνων", "παρατυπία αγοράς", "προειδοποίηση εποπτείας",
        "καταγγελία χειραγώγησης", "πειθαρχική διαδικασία", "αναστολή διαπραγμάτευσης",
    ],
}

# FIXED VALUES: boilerplate phrases, removed in this order by literal,
# case-sensitive substring replacement after lower-casing.
BOILERPLATE_PHRASES: list[str] = [
    "όροι χρήσης",
    "όροι και προϋποθέσεις",
    "πολιτική απορρήτου",
    "πολιτική cookies",
    "χρήση cookies",
    "all rights reserved",
    "copyright",
    "newsletter",
    "εγγραφείτε στο newsletter",
    "μήνυμα αποποίησης",
    "disclaimer",
    "διαβάστε περισσότερα εδώ",
]

# FIXED VALUES: characters kept by the analysis cleaner (after lower-casing,
# case-insensitive); every run of other characters becomes one space.
ANALYSIS_KEEP_CLASS = "0-9a-zάέήίόύώϊΐϋΰα-ω "

# FIXED VALUES: characters kept by the crawl-time cleaner: ASCII letters, the
# Greek and Coptic block U+0370-U+03FF, digits, . , ? ! ( ) ' " space, newline.
CRAWL_KEEP_CLASS = "A-Za-zͰ-Ͽ0-9.,?!()'\" \n"

# FIXED VALUES: script-ratio filter. Letters counted are U+03AC-U+03CE and
# U+0391-U+03A9; a text passes with >= 20 such letters or a share >= 0.10 of
# its first 3000 characters.
GREEK_LETTER_CLASS = "[ά-ώΑ-Ω]"
SCRIPT_SAMPLE_CHARS = 3000
SCRIPT_MIN_COUNT = 20
SCRIPT_MIN_RATIO = 0.10

# FIXED VALUES: language-detection sample length (characters).
LANG_SAMPLE_CHARS = 1000

# FIXED VALUES: crawl configuration.
CRAWL_MAX_DEPTH = 2
CRAWL_MAX_PAGES = 50

# FIXED VALUES: main-content container classes, tried before <article>/<body>.
CONTAINER_CLASSES = ["article-body", "entry-content", "post-content"]

# FIXED VALUES: raster pipeline constants.
INK_MIN_SUM = 100            # a mask is kept when its grey-value sum exceeds this
BLEND_WEIGHTS = (0.6, 0.4)   # context map, texture map
BLEND_THRESHOLD = 0.4        # strict: p > 0.4
SAMPLE_FRACTION = 0.05       # pixels sampled per image
SPLIT_SIZES = (564, 121, 121)
SPLIT_FALLBACK = (0.70, 0.15)
SPLIT_SEED = 42
F_BETA = 0.5
F_BETA_EPS = 1e-7
DICE_SMOOTH = 1.0
