"""Fixed values.

Every list and table in this module is a FIXED VALUE that must equal the
behaviour being reproduced (word lists, lexicon scores, label names,
thresholds, routing table).  They are stated plainly, in their natural
order.  Operators take them as default arguments, so a caller can pass
its own lexicon or label set instead.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# FIXED VALUES: text cleaning
# --------------------------------------------------------------------------

# Negation cues of the tagger (word-level cleaning).
TAGGER_NEGATION_CUES = [
    "not", "no", "never", "n't", "cannot", "can't", "dont", "don't",
    "didn't", "didnt", "won't", "wont", "isn't", "isnt", "aren't", "arent",
    "wasn't", "wasnt", "weren't", "werent", "shouldn't", "shouldnt",
    "couldn't", "couldnt", "wouldn't", "wouldnt",
]

# Contrast markers used by the clause split and the contrast flags.
TAGGER_CONTRAST_MARKERS = ["but", "however", "although", "though", "yet"]

# Abbreviation map, in its natural order.
ABBREVIATIONS = [
    ("gr8", "great"),
    ("thx", "thanks"),
    ("u", "you"),
    ("idk", "i do not know"),
    ("imo", "in my opinion"),
    ("w/", "with"),
    ("w/o", "without"),
    ("cant", "cannot"),
    ("can't", "cannot"),
    ("cant.", "cannot"),
    ("didnt", "did not"),
    ("didn't", "did not"),
]

DEFAULT_NEGATION_WINDOW = 3

# Token pattern of the negation tagger and its punctuation boundaries.
TAGGER_TOKEN_PATTERN = "[A-Za-z0-9']+|[.!?,;:]"
TAGGER_BOUNDARIES = [".", "!", "?", ",", ";", ":"]

# URL pattern removed before anything else.
URL_PATTERN = r"http\S+|www\.\S+"

# ASCII punctuation except the underscore.
PUNCT_CLASS = r"[!-/:-@\[-^`{-~]"

# Whitespace class shared by the JVM regex and RE2.
WS_CLASS = r"[\t\n\x0B\f\r ]+"

# --------------------------------------------------------------------------
# FIXED VALUES: sentiment lexicon (word -> score), natural order
# --------------------------------------------------------------------------
LEXICON = [
    ("outstanding", 5), ("superb", 5), ("excellent", 3), ("amazing", 4), ("fantastic", 4),
    ("wonderful", 4), ("awesome", 4), ("brilliant", 4), ("perfect", 3), ("love", 3),
    ("loved", 3), ("loving", 2), ("best", 3), ("great", 3), ("happy", 3),
    ("thrilled", 5), ("delighted", 3), ("excited", 3), ("satisfied", 2),
    ("good", 3), ("nice", 3), ("fine", 2), ("pleased", 3), ("glad", 3),
    ("enjoy", 2), ("enjoyed", 2), ("like", 2), ("liked", 2), ("recommend", 2),
    ("recommended", 2), ("helpful", 2), ("useful", 2), ("easy", 1), ("fast", 1),
    ("quick", 1), ("smooth", 1), ("simple", 1), ("convenient", 2), ("reliable", 2),
    ("thanks", 2), ("thank", 2), ("appreciate", 2), ("worth", 2), ("valuable", 2),
    ("beautiful", 3), ("lovely", 3), ("impressed", 3), ("impressive", 3),
    ("ok", 1), ("okay", 1), ("decent", 1), ("average", 0), ("fair", 1),
    ("alright", 1), ("acceptable", 1), ("adequate", 1), ("meh", 0),
    ("bad", -3), ("poor", -2), ("disappointing", -2), ("disappointed", -2),
    ("unfortunate", -2), ("unhappy", -2), ("upset", -2), ("frustrated", -2),
    ("frustrating", -2), ("annoying", -2), ("annoyed", -2), ("difficult", -1),
    ("hard", -1), ("slow", -1), ("late", -1), ("delayed", -1), ("wait", -1),
    ("waiting", -1), ("wrong", -2), ("broken", -2), ("failed", -2), ("fail", -2),
    ("issue", -1), ("issues", -1), ("problem", -2), ("problems", -2),
    ("trouble", -2), ("error", -2), ("confusing", -2), ("confused", -2),
    ("useless", -2), ("waste", -2), ("wasted", -2), ("regret", -2),
    ("dislike", -2), ("hate", -3), ("hated", -3), ("boring", -2),
    ("mediocre", -1), ("lackluster", -2), ("lacking", -1), ("missing", -1),
    ("cheap", -2), ("flimsy", -2), ("defective", -3), ("faulty", -2),
    ("terrible", -4), ("horrible", -4), ("awful", -4), ("worst", -4),
    ("disgusting", -4), ("dreadful", -4), ("pathetic", -3), ("ridiculous", -2),
    ("scam", -5), ("fraud", -5), ("fake", -4), ("stolen", -5), ("steal", -5),
    ("angry", -3), ("furious", -4), ("outraged", -4), ("nightmare", -4),
    ("atrocious", -5), ("abysmal", -5), ("horrendous", -4), ("appalling", -4),
    ("redeem", 1), ("redeemed", 1), ("balance", 0), ("gift", 1), ("card", 0),
    ("delivery", 0), ("delivered", 1), ("arrived", 1), ("received", 1),
    ("works", 2), ("worked", 2), ("working", 1), ("shipping", 0), ("shipped", 1),
    ("refund", -1), ("refunded", 0), ("return", -1), ("returned", 0),
    ("instant", 2), ("immediately", 2), ("promptly", 2), ("quickly", 1),
    ("sucks", -3), ("suck", -3), ("sucked", -3), ("crap", -3), ("crappy", -3),
    ("lame", -2), ("rubbish", -3), ("trash", -3), ("junk", -3),
    ("legit", 2), ("solid", 2), ("dope", 3), ("clutch", 3),
]

# Intensity multipliers, natural order.
INTENSIFIERS = [
    ("very", 1.5), ("really", 1.5), ("extremely", 2.0), ("absolutely", 2.0),
    ("completely", 1.8), ("totally", 1.8), ("highly", 1.5), ("incredibly", 2.0),
    ("amazingly", 2.0), ("exceptionally", 2.0), ("super", 1.5), ("so", 1.3),
    ("too", 1.3), ("quite", 1.2),
]

# Diminishers, natural order.  The multi-word entries can never equal a
# single token, so they never fire; they are kept for fidelity.
DIMINISHERS = [
    ("slightly", 0.5), ("somewhat", 0.6), ("barely", 0.3), ("hardly", 0.3),
    ("a bit", 0.5), ("a little", 0.5), ("kind of", 0.6), ("sort of", 0.6),
    ("fairly", 0.7), ("rather", 0.8),
]

# Negation cues of the lexicon scorer (wider than the tagger's list).
LEXICON_NEGATION_CUES = [
    "not", "no", "never", "n't", "cannot", "can't", "dont", "don't",
    "didn't", "didnt", "won't", "wont", "isn't", "isnt", "aren't", "arent",
    "wasn't", "wasnt", "weren't", "werent", "shouldn't", "shouldnt",
    "couldn't", "couldnt", "wouldn't", "wouldnt", "neither", "nor",
    "hardly", "barely", "nobody", "nothing", "nowhere", "without",
]

LEXICON_CONTRAST_MARKERS = ["but", "however", "although", "though", "yet", "except"]

LEXICON_TOKEN_PATTERN = "[a-z']+|[.,;:!?]"
LEXICON_SCOPE_ENDERS = [".", ",", ";", ":", "!", "?"]
CONTRAST_WEIGHT = 2.0

# --------------------------------------------------------------------------
# FIXED VALUES: issue labels and keyword phrases, natural order
# --------------------------------------------------------------------------
ISSUE_LABELS = [
    "delivery_shipping", "redemption_activation", "product_quality",
    "customer_service", "refund_return", "usability", "value_price",
    "fraud_scam", "other",
]

ISSUE_KEYWORDS = [
    ("delivery_shipping", ["delivery", "shipping", "ship", "shipped", "arrived", "arrival",
                           "late", "delay", "delayed", "slow", "lost package", "tracking"]),
    ("redemption_activation", ["redeem", "redemption", "activate", "activation", "code", "pin",
                               "invalid code", "code not working", "cannot redeem",
                               "card wont work", "card does not work"]),
    ("product_quality", ["broken", "defective", "damaged", "poor quality", "flimsy", "cheap",
                         "not as described", "bad quality"]),
    ("customer_service", ["customer service", "support", "representative", "agent", "help desk",
                          "unhelpful", "rude", "no response"]),
    ("refund_return", ["refund", "returned", "return", "money back", "chargeback",
                       "reimbursement", "exchange", "replacement"]),
    ("usability", ["confusing", "difficult", "hard to use", "complicated", "error", "failed",
                   "doesnt work", "does not work", "unable"]),
    ("value_price", ["expensive", "overpriced", "pricey", "waste of money", "not worth",
                     "too much"]),
    ("fraud_scam", ["scam", "fraud", "fake", "stolen", "unauthorized", "suspicious", "phishing",
                    "hack", "hacked"]),
]

# --------------------------------------------------------------------------
# FIXED VALUES: triage cascade word lists
# --------------------------------------------------------------------------
SINGLE_WORD_POSITIVE = [
    "ok", "okay", "ок", "oke", "good", "great", "nice", "love", "excellent",
    "amazing", "perfect", "awesome", "wonderful", "fantastic", "superb", "brilliant",
    "gr8", "gud", "gd", "luv", "thx", "tks", "ty", "tyvm", "tysm", "noice", "lit", "fire",
    "10/10", "5/5", "a+", "perf",
]
SINGLE_WORD_OK = ["ok", "okay", "oke"]
SINGLE_WORD_NEGATIVE = [
    "bad", "terrible", "awful", "horrible", "worst", "hate", "trash", "poor",
    "disappointed", "disappointing", "useless", "scam", "fraud", "fake",
    "sux", "sucks", "meh", "nah", "ugh", "wtf", "0/10", "1/10", "f",
]

CASCADE_CONTRAST_MARKERS = ["but", "however", "although", "though", "yet", "except"]

COMPLAINT_GROUPS = [
    ("shipping", ["slow", "late", "delayed", "wait", "waiting"]),
    ("quality", ["bad", "poor", "terrible", "awful", "horrible", "worst", "cheap", "flimsy",
                 "defective"]),
    ("packaging", ["damaged", "broken", "missing"]),
    ("service", ["rude", "unhelpful", "disappointing", "disappointed", "frustrated", "annoying"]),
    ("usability", ["confusing", "difficult", "hard", "complicated", "error", "failed"]),
    ("value", ["expensive", "overpriced", "waste", "useless", "scam"]),
    ("general", ["issue", "problem", "trouble", "wrong", "never"]),
]

SLANG_EXCLUSIONS = ["badass", "bad ass", "sick", "wicked", "killer", "insane"]

# Negation phrases searched in the 15 characters before a complaint word.
COMPLAINT_NEGATIONS = ["not ", "no ", "without ", "never had ", "zero ", "none ", "didn't have "]
COMPLAINT_LOOKBACK = 15

# Mapping of complaint group -> issue label.
ISSUE_TAG_TO_LABEL = [
    ("shipping", "delivery_shipping"),
    ("quality", "product_quality"),
    ("packaging", "product_quality"),
    ("service", "customer_service"),
    ("usability", "usability"),
    ("value", "value_price"),
    ("general", "other"),
]

# Queue priority contrast markers (padded substring test).
QUEUE_CONTRAST_MARKERS = [" but ", " however ", " although ", " though ", " yet "]

# --------------------------------------------------------------------------
# FIXED VALUES: decisions, risk and routing
# --------------------------------------------------------------------------
SENTIMENT_LABELS = ["NEGATIVE", "NEEDS_ATTENTION", "UNCERTAIN", "POSITIVE"]
LABEL_PRIORITY = [("NEGATIVE", 4), ("NEEDS_ATTENTION", 3), ("UNCERTAIN", 2), ("POSITIVE", 1)]
DEFAULT_THRESHOLDS = (0.40, 0.60)
BAND_PAIRS = [(0.40, 0.60), (0.45, 0.60), (0.50, 0.65), (0.55, 0.70)]
MIN_NNZ_DEFAULT = 2
CASCADE_NEGATIVE_CUTOFF = 0.40
CASCADE_CONFIDENT_POSITIVE = 0.95

# Routing playbook: primary issue -> (owner, outcome); default row last.
PLAYBOOK = [
    ("delivery_shipping", "Fulfillment + CSKH",
     "Offer recovery for delayed delivery and confirm shipment path."),
    ("redemption_activation", "Gift Card Platform Ops",
     "Verify code state and restore customer usability quickly."),
    ("refund_return", "Refund Desk",
     "Decide refund or replacement path based on usage status."),
    ("customer_service", "CSKH Supervisor",
     "Recover trust and close the service failure loop."),
    ("fraud_scam", "Trust & Safety",
     "Prevent loss and validate the claim before refunding."),
    ("product_quality", "Catalog / Vendor Ops",
     "Resolve product defect or packaging issue with evidence."),
    ("value_price", "Commercial Ops",
     "Address perceived value gap and check pricing consistency."),
]
PLAYBOOK_DEFAULT = ("CSKH Ops", "Acknowledge issue and confirm next step with the customer.")

# Annotation workflow statuses accepted as finished.
DONE_STATUSES = ["done", "reviewed", "completed", "annotated", "final"]

# Error-taxonomy padded substrings, natural order.
TAXONOMY_SLANG = [" gr8 ", " thx ", " idk ", " imo ", " w/ ", " w/o "]
TAXONOMY_NEGATION = [" not ", " no ", " never ", " cannot ", " can't ", " dont ", " didn't ", " didnt "]
TAXONOMY_CONTRAST = [" but ", " however ", " although ", " though ", " yet "]
TAXONOMY_DOMAIN = [" redeem", " code", " refund", " return", " delivery", " shipping", " support",
                   " scam", " fraud"]

# Short-text guard: sentiment indicator substrings (natural order).
SENTIMENT_INDICATORS = [
    "good", "bad", "great", "terrible", "excellent", "awful", "amazing",
    "horrible", "wonderful", "poor", "best", "worst", "love", "hate",
    "like", "nice", "fine", "okay", "ok", "perfect", "not",
    "disappointed", "happy", "satisfied", "recommend", "broken",
    "fast", "slow", "cheap", "expensive", "worth", "useless", "useful",
    "waste", "awesome", "sucks", "fantastic", "mediocre", "average",
]
