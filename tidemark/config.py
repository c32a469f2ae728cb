"""Settings.  Every operator takes these as arguments; the values below are only defaults.

The blocks marked FIXED VALUES must equal the reference's settings for results to agree.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------------------------
# FIXED VALUES: stress keyword tiers, asset categories and weights of the shipped feature
# configuration (the configuration file overrides the in-code defaults, so these are in effect).
# ---------------------------------------------------------------------------------------------
STRESS_KEYWORDS: dict[str, list[str]] = {
    "high_risk": ["recession", "crash", "collapse", "crisis", "panic", "selloff", "downturn",
                  "bubble", "default", "bankruptcy"],
    "medium_risk": ["volatility", "uncertainty", "correction", "slowdown", "decline", "risk",
                    "warning", "concern"],
    "low_risk": ["stable", "recovery", "growth", "rally", "bullish", "optimism", "strength"],
}
ASSET_CATEGORIES: dict[str, list[str]] = {
    "equities": ["stocks", "equities", "shares", "SPY", "QQQ"],
    "bonds": ["bonds", "treasuries", "yields", "Treasury"],
    "commodities": ["gold", "oil", "commodities", "crude"],
    "forex": ["currency", "forex", "dollar", "euro", "yen"],
    "crypto": ["crypto", "bitcoin", "ethereum", "blockchain"],
}
WEIGHTS: dict[str, float] = {"sentiment": 0.3, "keyword_stress": 0.4, "volume": 0.2, "recency": 0.1}
TIER_POINTS: dict[str, int] = {"high_risk": 3, "medium_risk": 2, "low_risk": 1}

# FIXED VALUES: the in-code fallback tiers and categories (used when no configuration is given).
DEFAULT_STRESS_KEYWORDS: dict[str, list[str]] = {
    "high_risk": ["crash", "plunge", "collapse", "panic", "crisis", "turmoil", "recession",
                  "bear market", "sell-off", "volatility spike", "default", "bankruptcy",
                  "emergency"],
    "medium_risk": ["decline", "fall", "drop", "weakness", "concern", "risk", "uncertainty",
                    "warning", "pressure", "correction", "loss"],
    "low_risk": ["caution", "watch", "monitor", "attention", "mixed", "fluctuation", "variation",
                 "change"],
}
DEFAULT_ASSET_CATEGORIES: dict[str, list[str]] = {
    "equities": ["S&P", "Dow", "NASDAQ", "stock", "equity", "index", "Russell"],
    "commodities": ["gold", "silver", "oil", "crude", "copper", "gas", "metal"],
    "forex": ["EUR", "USD", "GBP", "JPY", "CHF", "currency", "forex", "dollar"],
    "crypto": ["bitcoin", "BTC", "ethereum", "ETH", "crypto"],
    "volatility": ["VIX", "volatility", "fear", "stress"],
}

# FIXED VALUES: instrument dimension (name, symbol, type, priority, url).
INSTRUMENTS: list[tuple[str, str, str, int, str]] = [
    ("S&P 500", "^GSPC", "index", 1, "https://finance.yahoo.com/quote/%5EGSPC"),
    ("Dow Jones", "^DJI", "index", 1, "https://finance.yahoo.com/quote/%5EDJI"),
    ("NASDAQ", "^IXIC", "index", 1, "https://finance.yahoo.com/quote/%5EIXIC"),
    ("VIX", "^VIX", "volatility", 1, "https://finance.yahoo.com/quote/%5EVIX"),
    ("Russell 2000", "^RUT", "index", 2, "https://finance.yahoo.com/quote/%5ERUT"),
    ("Gold", "GC=F", "commodity", 1, "https://finance.yahoo.com/quote/GC=F"),
    ("Silver", "SI=F", "commodity", 2, "https://finance.yahoo.com/quote/SI=F"),
    ("US 10Y Bond", "^TNX", "bond", 1, "https://finance.yahoo.com/quote/%5ETNX"),
]

# FIXED VALUES: validation limits and misc thresholds.
MIN_TEXT_LENGTH = 20
MAX_TEXT_LENGTH = 1000
SHORT_HEADLINE = 10
MARKET_SOURCE_PATTERN = "investing.com|yahoo_finance"
TRADING_DAYS = 252
CONFIDENCE_THRESHOLD = 0.7
REGIME_BINS = (0.3, 0.7)

# Published constants of the rule-based (VADER-style) compound score.
VADER_ALPHA = 15.0
VADER_NEGATION_SCALAR = -0.74
VADER_BOOSTER_INCREMENT = 0.293
VADER_EXCLAMATION_INCREMENT = 0.292
VADER_MAX_EXCLAMATIONS = 4


@dataclass(frozen=True)
class Lexicon:
    """Sentiment lexicon as data.  ``valence`` feeds the compound score, ``polarity`` and
    ``subjectivity`` feed the averaging scorer.  Any table of this shape can be passed."""

    valence: dict[str, float]
    polarity: dict[str, float] = field(default_factory=dict)
    subjectivity: dict[str, float] = field(default_factory=dict)
    negations: tuple[str, ...] = ("not", "no", "never", "none", "nothing", "neither", "nor",
                                  "cannot", "without")
    boosters: dict[str, float] = field(default_factory=dict)


# Small self-written English seed lexicon (not a copy of any published list).
SEED_LEXICON = Lexicon(
    valence={
        "crash": -2.8, "collapse": -2.7, "crisis": -2.6, "panic": -2.6, "plunge": -2.3,
        "plunges": -2.3, "fall": -1.2, "falls": -1.2, "decline": -1.4, "loss": -1.6,
        "fear": -2.0, "risk": -0.9, "weak": -1.3, "bad": -2.3, "worse": -2.1, "worst": -3.0,
        "concern": -1.2, "warning": -1.4, "default": -1.5, "recession": -2.4,
        "gain": 1.6, "gains": 1.6, "rise": 1.1, "rises": 1.1, "surges": 2.0, "rally": 1.8,
        "growth": 1.7, "strong": 1.8, "good": 1.9, "great": 3.1, "best": 3.2,
        "stable": 1.3, "recovery": 1.6, "bullish": 2.0, "optimism": 2.2, "strength": 1.7,
    },
    polarity={
        "crash": -0.6, "collapse": -0.6, "crisis": -0.5, "panic": -0.5, "bad": -0.7,
        "worse": -0.4, "worst": -1.0, "weak": -0.375, "fall": -0.2, "loss": -0.3,
        "good": 0.7, "great": 0.8, "best": 1.0, "strong": 0.433, "stable": 0.3,
        "gain": 0.3, "growth": 0.25, "bullish": 0.5, "optimism": 0.5, "high": 0.16, "low": 0.0,
    },
    subjectivity={
        "crash": 0.8, "collapse": 0.7, "crisis": 0.6, "panic": 0.9, "bad": 0.667,
        "worse": 0.6, "worst": 1.0, "weak": 0.625, "fall": 0.3, "loss": 0.4,
        "good": 0.6, "great": 0.75, "best": 0.3, "strong": 0.733, "stable": 0.5,
        "gain": 0.5, "growth": 0.4, "bullish": 0.8, "optimism": 0.9, "high": 0.54, "low": 0.3,
    },
    boosters={"very": 1.0, "extremely": 1.0, "highly": 1.0, "slightly": -1.0, "barely": -1.0},
)

# Binding for the driver tables (invented multilingual prose): none of the real keywords occur,
# so the registered queries pass words that do occur.  Unit tests use the real lists above.
BINDING_KEYWORDS: dict[str, list[str]] = {
    "high_risk": ["ther", "reti"],
    "medium_risk": ["that", "with"],
    "low_risk": ["from", "this"],
}
BINDING_CATEGORIES: dict[str, list[str]] = {
    "equities": ["the", "and"],
    "bonds": ["der", "und"],
    "commodities": ["oil", "gold"],
    "forex": ["yen", "dollar", "euro"],
    "volatility": ["que", "les"],
}
BINDING_LEXICON = Lexicon(
    valence={"the": 0.6, "and": 1.1, "of": -0.4, "to": 0.3, "in": -0.2, "de": -0.9,
             "la": 1.4, "der": -1.3, "und": 0.8, "that": -1.7, "with": 2.1, "this": -2.2,
             "from": 1.9, "que": -0.7, "die": -2.5},
    polarity={"the": 0.1, "and": 0.25, "of": -0.1, "de": -0.3, "la": 0.5, "der": -0.5,
              "that": -0.6, "with": 0.4, "this": -0.8, "from": 0.7},
    subjectivity={"the": 0.2, "and": 0.5, "of": 0.1, "de": 0.6, "la": 0.9, "der": 0.4,
                  "that": 0.7, "with": 0.3, "this": 1.0, "from": 0.8},
    negations=("not", "nicht", "ne", "no"),
    boosters={"very": 1.0, "is": 1.0, "es": -1.0},
)

# Instrument dimension for the ``events`` binding: each event type plays one instrument.
# (event_type, asset name, asset_type, priority)
BINDING_INSTRUMENTS: list[tuple[str, str, str, int]] = [
    ("signup", "Signup Index", "index", 1),
    ("view", "View Index", "index", 2),
    ("click", "Click Metal", "commodity", 1),
    ("error", "Error VIX", "volatility", 1),
    ("purchase", "Purchase Bond", "bond", 2),
]
