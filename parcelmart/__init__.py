"""Parcel-delivery marts as Spark DataFrame plans."""
