"""Cleaning, reports, price models and batch scoring of event listings on Spark."""
