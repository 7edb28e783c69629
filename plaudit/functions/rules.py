"""Rule lists and the expressions folded from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# ---- fixed values -----------------------------------------------------------
SENTIMENTS = ("negative", "neutral", "positive")

# upper bound (exclusive), label
PRICE_BANDS = (
    (500, "1. Under 500"),
    (1000, "2. 500-999"),
    (3000, "3. 1,000-2,999"),
    (10000, "4. 3,000-9,999"),
)
TOP_PRICE_BAND = "5. 10,000+"

# pattern on the lower-cased product name, category; the first match wins
CATEGORY_RULES = (
    (r"wall clock|bedsheet|bed sheet|curtain|cushion|showpiece|pillow|blanket|carpet|doormat", "Home Decor & Furnishing"),
    (r"football|cricket|gym|bicycle|\bcycle\b|yoga|dumbbell|badminton|abdomen|fitness|skipping", "Sports & Fitness"),
    (r"\bmop\b|dettol|serum|face|shampoo|soap|lotion|cream|mamaearth|detergent|cleaner|cleaning|antiseptic|sanitizer|perfume|deodorant", "Personal Care & Cleaning"),
    (r"\btoy|toys|seed|plant|garden|puzzle|doll|remote control|\bcar\b", "Toys & Garden"),
    (r"\bfan\b|cooler|air conditioner|\bac\b|\biron\b|heater|geyser|washing|wash\b|refrigerator|vacuum|purifier|sewing|trimmer|shaver|dryer|chimney|inverter|\bups\b|food processor|stabili[sz]er|mixer|grinder|juicer|blender|oven|cooker|kettle|toaster|induction|chopper", "Appliances"),
    (r"dinner|flask|bottle|jar|\bpan\b|tawa|lunch|casserole|cookware|utensil|steel|opalware|glass|\bcup|mug|plate|bowl|kitchen", "Kitchen & Dining"),
    (r"bluetooth|speaker|headphone|earphone|earbud|neckband|\bled\b|\btv\b|smart|\bssd\b|hard disk|pen drive|memory card|laptop|mobile|phone|charger|cable|power bank|watch|\bband\b|mouse|keyboard|camera|router|printer|\bink\b|samsung|redmi|realme|poco|ipad|apple|chromecast|streaming|wifi|wi-fi|\bgb\b", "Electronics & Accessories"),
    (r"\bmen\b|women|shirt|jeans|shoe|sneaker|sandal|slipper|kurta|saree|jacket|\bcap\b|belt|wallet|\bbag\b|backpack|sunglass|cotton", "Fashion & Apparel"),
    (r"curtain|bedsheet|cushion|clock|lamp|shelf|rack|table|chair|sofa|\bbed\b|mattress|pillow|blanket|carpet|\bmat\b|frame|showpiece|stand|organi[sz]er|holder|door|wardrobe|light|home|wood|book", "Home Decor & Furnishing"),
)
OTHER_CATEGORY = "Other"
MISSING_TITLE = "Nan"
# -----------------------------------------------------------------------------


def first_match(cases: Sequence[tuple[Column, str]], default: str) -> Column:
    (condition, label), *rest = cases
    chain = F.when(condition, F.lit(label))
    for condition, label in rest:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(default))


def sentiment_of(rating: Column) -> Column:
    negative, neutral, positive = SENTIMENTS
    return first_match([(rating >= 4, positive), (rating == 3, neutral)], negative)


def band_of(
    amount: Column,
    bands: Sequence[tuple[float, str]] = PRICE_BANDS,
    top: str = TOP_PRICE_BAND,
) -> Column:
    return first_match([(amount < bound, label) for bound, label in bands], top)


def category_of(
    lowered_name: Column,
    rules: Sequence[tuple[str, str]] = CATEGORY_RULES,
    default: str = OTHER_CATEGORY,
) -> Column:
    return first_match([(lowered_name.rlike(pattern), label) for pattern, label in rules], default)


def class_label(sentiment: Column, classes: Sequence[str] = SENTIMENTS) -> Column:
    """Position of the sentiment in ``classes``; NULL when it is not one of them."""
    chain = F.when(sentiment == classes[0], F.lit(0.0))
    for position, name in enumerate(classes[1:], start=1):
        chain = chain.when(sentiment == name, F.lit(float(position)))
    return chain
