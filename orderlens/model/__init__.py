"""Low-review risk model: features and split, ridge logistic CV, evaluation, daily scoring."""
