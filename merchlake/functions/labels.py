"""Fixed labels and page lists shared by dimensions, facts and marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Members standing for a missing marketing attribute.
MISSING_MEMBERS = {
    "utm_source": "(non renseigné)",
    "utm_campaign": "(non renseignée)",
    "utm_content": "(non renseigné)",
    "http_referer": "(aucun)",
}
MARKETING_ATTRIBUTES = list(MISSING_MEMBERS)

# Device labels, customer segments, chart labels.
DEVICE_TYPES = ["desktop", "mobile"]
DEVICE_LABELS = {"desktop": "ordinateur", "mobile": "mobile"}
PROSPECT, BUYER, REPEAT_BUYER = "prospect", "acheteur", "acheteur récurrent"
NO_SOURCE_LABEL, NO_CAMPAIGN_LABEL = "direct", "sans campagne"

# Page addresses of the funnel steps, in funnel order.
FUNNEL_PAGES = {
    "product_list": ["/products"],
    "product_detail": [
        "/the-original-mr-fuzzy",
        "/the-forever-love-bear",
        "/the-birthday-sugar-panda",
        "/the-hudson-river-mini-bear",
    ],
    "cart": ["/cart"],
    "shipping": ["/shipping"],
    "billing": ["/billing", "/billing-2"],
}

# Stage names of the overall funnel, in order, with the mart column they sum.
FUNNEL_STAGES = [
    ("Sessions", "sessions"),
    ("Liste produits", "product_list_sessions"),
    ("Fiche produit", "product_detail_sessions"),
    ("Panier", "cart_sessions"),
    ("Livraison", "shipping_sessions"),
    ("Facturation", "billing_sessions"),
    ("Commande", "order_sessions"),
]


def or_member(attribute: str, column: Column | None = None) -> Column:
    """The attribute, or the member that stands for its absence."""
    source = F.col(attribute) if column is None else column
    return F.coalesce(source, F.lit(MISSING_MEMBERS[attribute]))


def device_label(device: Column) -> Column:
    label = device
    for value, text in DEVICE_LABELS.items():
        label = F.when(device == value, F.lit(text)).otherwise(label)
    return label


def customer_status(order_count: Column) -> Column:
    return (
        F.when(order_count == 0, F.lit(PROSPECT))
        .when(order_count == 1, F.lit(BUYER))
        .otherwise(F.lit(REPEAT_BUYER))
    )


def channel_label(source: Column, campaign: Column, is_direct: Column) -> Column:
    return F.concat(
        F.coalesce(source, F.lit(NO_SOURCE_LABEL)),
        F.lit(" / "),
        F.coalesce(campaign, F.lit(NO_CAMPAIGN_LABEL)),
        F.when(is_direct, F.lit(" / direct")).otherwise(F.lit("")),
    )
