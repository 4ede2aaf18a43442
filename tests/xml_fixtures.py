"""Own notification XML fixtures (FIXTURES.md §1 cases)."""

from __future__ import annotations

import os


def offer(seller, winner="true", featured="true", fba="false", domestic="true", listing="10.00",
          shipping="2.50", hours=(24, 48), notes=False, extra=""):
    parts = [f"<Offer><SellerId>{seller}</SellerId>"]
    if notes:
        parts.append("<ConditionNotes/>")
    if listing is not None:
        parts.append(f"<ListingPrice><Amount>{listing}</Amount><CurrencyCode>EUR</CurrencyCode></ListingPrice>")
    if shipping is not None:
        parts.append(f"<Shipping><Amount>{shipping}</Amount></Shipping>")
    if hours is not None:
        parts.append(f'<ShippingTime minimumHours="{hours[0]}" maximumHours="{hours[1]}" availabilityType="NOW"/>')
    parts.append("<SellerFeedbackRating><SellerPositiveFeedbackRating>98</SellerPositiveFeedbackRating>"
                 "<FeedbackCount>120</FeedbackCount></SellerFeedbackRating>")
    parts.append("<ShipsFrom><Country>FR</Country></ShipsFrom><SubCondition>new</SubCondition>")
    for tag, val in (("IsFulfilledByAmazon", fba), ("IsBuyBoxWinner", winner),
                     ("IsFeaturedMerchant", featured), ("ShipsDomestically", domestic)):
        if val is not None:
            parts.append(f"<{tag}>{val}</{tag}>")
    parts.append(extra + "</Offer>")
    return "".join(parts)


def notification(customer, market, asin, when, offers):
    return ("<?xml version=\"1.0\"?><Notification><NotificationMetaData>"
            f"<SellerId>{customer}</SellerId></NotificationMetaData><NotificationPayload>"
            "<AnyOfferChangedNotification><OfferChangeTrigger>"
            f"<MarketplaceId>{market}</MarketplaceId><ASIN>{asin}</ASIN>"
            f"<TimeOfOfferChange>{when}</TimeOfOfferChange></OfferChangeTrigger>"
            f"<Offers>{''.join(offers)}</Offers></AnyOfferChangedNotification>"
            "</NotificationPayload></Notification>")


def write_tree(root: str) -> dict:
    """Write the fixture folder; returns expectations."""
    os.makedirs(os.path.join(root, "a", "b"), exist_ok=True)
    files = {
        "good1.xml": notification("S1", "A13V1IB3VIYZZH", "P1", "2017-01-27T15:34:28.123Z",
                                  [offer("S1", winner="false", listing="11.00", notes=True),
                                   offer("A1X6FK5RDHNB96", winner="True", listing="10.00"),
                                   offer("S3", winner="false", listing=None, shipping=None,
                                         hours=None)]),
        "a/good2.xml": notification("S2", "A13V1IB3VIYZZH", "P1", "2017-01-28T10:00:00.000Z",
                                    [offer("S2", winner="true"), offer("S4", winner="false")]),
        "a/b/broken.xml": "<Notification><NotificationMetaData><SellerId>x</SellerId>",
        "a/b/missing.xml": notification("S5", "A13V1IB3VIYZZH", "P2", "2017-01-29T10:00:00.000Z",
                                        [offer("S5", winner=None)]),
        "a/b/headless.xml": "<Notification>" + notification(
            "", "A13V1IB3VIYZZH", "P3", "2017-01-29T11:00:00.000Z", [offer("")]).split("</NotificationMetaData>")[1],
        "a/notes.txt": "not xml",
    }
    for name, text in files.items():
        with open(os.path.join(root, name), "w") as fh:
            fh.write(text)
    return {"good_rows": 5, "bad": {"broken", "missing", "headless"}}
