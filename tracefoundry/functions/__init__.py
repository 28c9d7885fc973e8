"""Part of tracefoundry."""
