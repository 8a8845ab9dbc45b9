"""Jobs (bronze -> silver), table loads, marts (gold) and the daily run."""
