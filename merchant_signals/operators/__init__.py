"""DataFrame -> DataFrame operators of the merchant-risk data product."""
