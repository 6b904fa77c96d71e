"""trialweave.sources"""
