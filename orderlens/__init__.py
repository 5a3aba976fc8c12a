"""orderlens: e-commerce order warehouse, SLA marts, RFM, review-risk model and scoring on Spark."""

__version__ = "0.1.0"
