"""Explicit schemas of the two raw tables and of the nested pages they come from."""

from pyspark.sql.types import (
    BooleanType, DataType, DoubleType, LongType, StringType, StructField, StructType,
)

from tastelens import fixed_values as fv

LONG, DOUBLE, TEXT, FLAG = LongType(), DoubleType(), StringType(), BooleanType()


def record(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


RESTAURANTS = record(
    **{fv.PLACE_ID: LONG}, name=TEXT, link=TEXT, rating=DOUBLE, reviews_count=LONG,
    price_range=TEXT, phone=TEXT, is_open_now=FLAG, status_text=TEXT, address=TEXT, city=TEXT,
    postal_code=TEXT, country=TEXT, country_code=TEXT, latitude=DOUBLE, longitude=DOUBLE,
    parent_location_id=LONG, parent_location_name=TEXT, featured_image=TEXT,
    has_reservation=FLAG, has_delivery=FLAG, is_ad=FLAG,
)

# Counts and dates stay text here; cleaning reads them and turns what is unreadable into missing.
REVIEWS = record(
    restaurant_entity_id=LONG, restaurant_name=TEXT, restaurant_link=TEXT, review_id=LONG,
    review_link=TEXT, title=TEXT, text=TEXT, rating=DOUBLE, language=TEXT, original_language=TEXT,
    like_count=TEXT, trip_type=TEXT, stay_date=TEXT, created_at_date=TEXT, published_at_date=TEXT,
    reviewer_id=TEXT, reviewer_name=TEXT, reviewer_username=TEXT, reviewer_profile_link=TEXT,
    reviewer_contribution_count=TEXT, reviewer_hometown=TEXT,
)

RESTAURANT_ITEM = record(
    **{fv.PLACE_ID: LONG}, name=TEXT, link=TEXT, rating=DOUBLE, reviews=LONG,
    price_range=TEXT, phone=TEXT, is_open_now=FLAG, status_text=TEXT,
    address=record(address=TEXT, city=TEXT, postal_code=TEXT, country=TEXT, country_code=TEXT),
    coordinates=record(latitude=DOUBLE, longitude=DOUBLE),
    parent_location=record(**{fv.PLACE_ID: LONG}, name=TEXT),
    featured_image=TEXT, has_reservation=FLAG, has_delivery=FLAG, is_ad=FLAG,
)

REVIEW_ITEM = record(
    review_id=LONG, review_link=TEXT, title=TEXT, text=TEXT, rating=DOUBLE, language=TEXT,
    original_language=TEXT, like_count=LONG, trip=record(trip_type=TEXT, stay_date=TEXT),
    created_at_date=TEXT, published_at_date=TEXT,
    reviewer=record(
        reviewer_id=TEXT, name=TEXT, username=TEXT, profile_link=TEXT, contribution_count=LONG,
        hometown=record(location_name_detailed=TEXT),
    ),
)

PLACE_ITEM = record(name=TEXT, place_type=TEXT, **{fv.PLACE_ID: LONG})
