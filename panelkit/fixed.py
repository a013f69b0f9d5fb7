"""They must equal the panel's published codes and labels, or results differ."""

# English month abbreviations in calendar order.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# Old-format period type -> head of its period label.
OLD_PERIOD_HEADS = {
    "MAT/ 52 we": "MAT",
    "2MAT/ 104 we": "2MATs",
    "3MMT/ 12we": "3MMT",
    "Monthly": "Month",
}

# New-format duration in months -> period type.
PERIOD_TYPES = {24: "2MATs/ 104 we", 12: "MAT/ 52 we", 3: "3MMT/ 12we", 1: "Month"}

# Old-format period types as the type dictionary spells them.
OLD_PERIOD_SPELLING = {"Monthly": "Month", "2MAT/ 104 we": "2MATs/ 104 we"}

# Piece of a file name -> category; the first piece found decides.
FILE_CATEGORIES = [
    ("br", "MALE B&R"),
    ("deterg", "Laundry Detergents"),
    ("diapers", "Diapers"),
    ("femcare", "Feminine Care"),
    ("haircond", "Hair Conditioners"),
    ("shampoo", "Shampoos"),
    ("MALE B&R", "MALE B&R"),
    ("Laundry Detergents", "Laundry Detergents"),
    ("Diapers", "Diapers"),
    ("Feminine Care", "Feminine Care"),
    ("Hair Conditioners", "Hair Conditioners"),
    ("Shampoos", "Shampoos"),
]

# Root label of a category tree -> category code.
CATEGORY_CODES = {
    "0. Diapers": 1,
    "0. MALE B&R": 2,
    "0. Conditioners": 3,
    "0. Shampoos": 4,
    "0. Total Feminine Care": 5,
    "0. Laundry Detergents": 6,
}

# Detergent nodes taken out of the tree, and the node that gets a new parent.
DETERGENT_CATEGORY = "Laundry Detergents"
DETERGENT_DROPPED = [239495, 475025, 475026]
DETERGENT_PARENTS = {475027: 250455}

# Spellings brought in line with the dictionaries.
SHOP_SPELLING = {"Ok Hyper": "OK Hyper", "Perekryostok": "Perekrestok"}
BUYER_SPELLING = {"Total Population": "TOTAL DEMOGRAPHICS"}
SEGMENT_SPELLING = {"Total Diapers size": "Total Diapers"}
DETERGENT_SEGMENT_SPELLING = {"Total Detergents excluding Bars": "Total Detergents excluding Bar"}

# Segment of a category whose files carry none.
DEFAULT_SEGMENTS = {"Feminine Care": "Total Feminine Care", "Shampoos": "Shampoos"}

# Buyer group code of the demographic total, code of the national shop.
TOTAL_DEMO = 1
NATIONAL = 1

# The metrics of an old-format flat file.
OLD_METRICS = [
    "Buying Households",
    "Projected Shoppers",
    "Panel Sample Size",
    "Raw Shoppers",
    "Loyalty Volume Based",
    "Loyalty Value Based Local Currency",
    "Loyalty Value Based USD",
    "Percent 2+ Time Buyers",
    "Percent Household Penetration",
    "Purchase Frequency",
    "Occasions",
    "Item Buying Rate local currency",
    "Item Buying Rate USD",
    "Purchase size local currency",
    "Purchase size USD",
    "Purchase size SU",
    "Average per SU local currency",
    "Average per SU USD",
    "Volume SU",
    "Volume Physical Units",
    "Spend Local Currency",
    "Spend USD",
]

# Normalised metric name -> display label.
METRIC_LABELS = {
    "buying_households": "Buyers (000 HH)",
    "raw_shoppers": "Raw Buyers",
    "loyalty_volume_based": "Loyalty Volume",
    "loyalty_value_based_local_currency": "Loyalty Value RUB",
    "loyalty_value_based_usd": "Loyalty Value USD",
    "percent_2__time_buyers": "Repeat Rate (percent of buyers with frequency 2 and more)",
    "percent_household_penetration": "Penetration",
    "purchase_frequency": "Frequency",
    "occasions": "Trips (000)",
    "item_buying_rate_local_currency": "Spend per buyer RUB",
    "item_buying_rate_usd": "Spend per buyer USD",
    "purchase_size_local_currency": "Spend per trip RUB",
    "purchase_size_usd": "Spend per trip USD",
    "purchase_size_su": "Volume per trip SU",
    "average_per_su_local_currency": "Average Price per SU (RUB)",
    "average_per_su_usd": "Average Price per SU USD",
    "volume_su": "Volume SU (000)",
    "volume_physical_units": "Volume Packs (000)",
    "spend_local_currency": "Value RUB (000)",
    "spend_usd": "Value USD (000)",
    "value_share": "Value share, % of Total Demography",
    "buyers_share": "Buyers share, % of Total Demography",
}

# Metrics that old files give in units, and old metrics that are unusable.
METRICS_IN_UNITS = [
    "buying_households",
    "occasions",
    "volume_physical_units",
    "volume_su",
    "spend_local_currency",
    "spend_usd",
]
UNUSABLE_OLD_METRICS = [
    "average_per_su_local_currency",
    "average_per_su_usd",
    "purchase_size_su",
    "volume_su",
]
