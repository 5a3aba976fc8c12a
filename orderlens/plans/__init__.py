"""Products as DataFrame plans: warehouse, marts, RFM, quality jobs, reports, the whole run."""
