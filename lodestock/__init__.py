"""Supply-chain analytics as plain DataFrame-to-DataFrame functions."""
