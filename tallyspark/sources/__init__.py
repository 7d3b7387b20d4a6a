"""Raw store, output tables and staged tables."""
