"""Sentences with things that may be personal data between « and », written by hand: y if they are, n if they only look so. X stands for any digit.

None of them comes from the generator that the trees are fitted on. The first four lists were in view when the probability that a
candidate must have was chosen; the LATER ones were written after that, and nothing was changed in view of them.
"""

EMAIL = """
y Please contact «anna.schmidt [at] firma [dot] de» before Friday.
y You can reach our team via «support(at)widgets(dot)com» any time.
y My e-mail is «kowalski_XX at posteo dot net», thanks a lot.
y Write to «maria.lopez [at] correo.example.org» for the schedule.
y For press enquiries mail «press {at} northwind {dot} org».
y The maintainer (j.doe <at> kernel-fan <dot> io) did not answer. «j.doe <at> kernel-fan <dot> io»
y Kontakt: «p.weber＠beispiel.de» oder per Post.
y Send your CV to «jobs (at) acme-labs (dot) com» please.
y if that fails, email «robert.old [AT] mailhost.co» directly
y Reply to «lena_m at gmx dot de» if you want the second ticket.
y Feedback goes to «feedback[at]opengarden[dot]info».
y Her address was «d.tanaka [at] univ.example.edu» last year.
n The parts are available «at example.com» for less.
n They are «available at example.com» for less than ten euros.
n We met him «home at noon.Then» we left.
n The bus arrived «late at 9.45» and was full.
n Please «look at section.four» of the handbook.
n Have a «look at this.That» is all.
n Tickets are «sold at ticketshop.net» only.
n The files are «hosted at mirror.org» since May.
n You can «shop at bookworld.com» as well.
n He laughed «back at them.Nobody» minded.
n Try «online at weather.gov» for the forecast.
n She looked «up at dot com» shares again.
n We stayed «there at midnight.Nothing» happened.
n Everything on sale «now at outlet.de» until Sunday.
""".strip()

IP = """
y The peer answered from «2001:db8:85a3:0:0:8a2e:370:7334» at once.
y ping «fe80::1cXX:8aff:fe0d» works
y Login from «2a02:8109:9a80::1f4e» was refused.
y The attacker used «203[.]0[.]113[.]XX» as a relay.
y We blocked «198(.)51(.)100(.)23» last night.
y His host is «2001:db8::ff00:42:8329» now.
y Traffic to «185[.]220[.]101[.]4X» was dropped.
y Connections came in over «2606:4700:20::681a:b32» only.
y client «2001:41d0:8:e8ad::1» closed the session
y the server at «192 [dot] 168 [dot] 20 [dot] 5» is down
n The film starts at «20:15:00» sharp.
n The record stands at «02:01:39» since autumn.
n Mix sand, lime and water as «4:2:1» by volume.
n The adapter shows «00:1b:44:11:3a:b7» on its label.
n Its MAC is «3c:52:82:0f:aX:19».
n See Numbers «12:3:6» and the next verse.
n The call «abc::bad» returns nothing.
n We split it «5:3:2:1» among the four.
n The trace begins at «11:59:5X» and ends a minute later.
n In the model «face::feed» is a namespace.
n Run time was «01:12:4X» in total.
n The scores were «21:19:21» in the end.
""".strip()

CARD = """
y My visa is «4111.1111.1111.1111», valid until May.
y Please charge card «5500_0000_0000_0004» for the rest.
y The card «4012/8888/8888/1881» was declined.
y pay with mastercard «5105.1051.0510.5100» today
y credit card no «6011.0009.9013.9424»
y Kreditkarte «4222222222222», gültig bis 2027.
y Amex «3782.822463.10005» on file
y payment by «4000/0566/5566/5556» received
y debit «5200_8282_8282_8210» was used twice
y numéro de carte «4242.4242.4242.4242» merci
y tarjeta «5555/5555/5555/4444» por favor
n The order «4111.1111.1111.1112» has shipped.
n Invoice «2024/1103/5521/0098» is due.
n Serial number «8812.4417.0091.3327» on the back.
n Tracking code «9400_1118_9922_3197» was scanned.
n The meeting of «2024.11.05.10» was moved.
n On «2023/10/31/12» the build broke.
n Measured values were «1200 1350 1475 1600» in a row.
n ISBN «978-0306-40615-70» is out of print.
n Ticket «1234.5678.9012.3456» was closed.
n Article «7612/4410/0019/2231» is sold out.
n The values «4416_2210_9981_0032» are made up.
n Model «3300.1200.4500.7701» replaces it.
""".strip()

PHONE = """
y Call me on «(415) 555-01XX» after six.
y My mobile is «555-867-53XX», leave a message.
y Phone: «212.555.01XX» from nine to five.
y You can dial «0044 207 94601XX» from abroad.
y Fax «(030) 901-8200» for forms.
y text «646 555 01XX» to join
y Her cell: «(206) 555-0144» works best.
y Tel. «0221 555 04XX» ist besetzt.
y ring «(312) 555-0187» and ask for Jo
y whatsapp «718-555-01XX» please
y For repairs call «800-555-01XX» toll free.
y The office («(503) 555-0162») opens at eight. «(503) 555-0162»
n Order «415-555-0199» ships on Monday.
n Part «867-530-9123» fits the old pump.
n The invoice 2«24-118-0093» is unpaid. «224-118-0093»
n See page «120 134 2077» of the catalogue.
n Version «10.204.3391» fixes it.
n Build «221.884.1203» failed overnight.
n Serial «339-201-4457» was recalled.
n The SKU is «120/443/2219».
n Case «771-204-3358» was closed in May.
n Tracking id «552 118 9034» is unknown.
n Ticket «118-220-4471» waits for review.
n It weighs «1200 340512» units of nothing.
n The ref «884.120.3319» is on the label.
n Article «443 210 8876» is back in stock.
""".strip()

LATER_EMAIL = """
y Ask the treasurer, «h.brandt [at] verein [dot] de», for a receipt.
y our contact is «orders(at)teahouse(dot)co», reply within a day
y Schreiben an «buero at kanzlei-roth dot de» genügt.
y Send the photos to «nina_XX [at] lightbox.net» tonight.
y courriel: «j.moreau(at)atelier.fr»
y «helpdesk {at} campus {dot} edu» is where bugs go
y The author, «t.okafor＠press.org», revised the text.
y reach Sam under «sam.hill <at> ridge <dot> io»
n The book is «out at publisher.com» next week.
n We ate «lunch at noon.Later» it rained.
n More is «found at library.org» and elsewhere.
n Prices «start at 19.99» this month.
n You may «read at home.Or» in the park.
n Get it «free at musicbox.net» while it lasts.
n The crowd «shouted at him.He» left.
n Doors «open at eight.Bring» a coat.
""".strip()

LATER_IP = """
y gateway «2a00:1450:4001:81b::200e» did not reply
y The bot came from «91[.]219[.]236[.]1X» on Monday.
y dns is «2001:4860:4860::8888» here
y his client had «fd12:3456:789a:1::1» then
y Requests by «45(.)155(.)204(.)3X» were dropped.
y We saw «2607:f8b0:4005:805:0:0:0:200e» in the log.
n He finished in «03:58:4X» and smiled.
n The card reads «a4:83:e7:1b:00:9f» in small print.
n Use water and flour «3:5:2» here.
n It ran from «08:30:00» until lunch.
n Chapter «7:14:2» says so.
n The symbol «cafe::babe» is private.
""".strip()

LATER_CARD = """
y card «4556.7375.8689.9855» was stolen
y debit the visa «4485_2757_4230_8327» instead
y her mastercard «5425/2334/3010/9903» expires soon
y please bill credit «4916.3385.0608.2832» monthly
y the amex «3714.496353.98431» is mine
n Order «4556.7375.8689.9856» was sent twice.
n Container «2210/8874/0031/5562» was unloaded.
n Results were «1410 1388 1422 1399» per run.
n Serial «7731_0042_8819_2206» is worn off.
n Between «2019.06.14.22» and now nothing changed.
""".strip()

LATER_PHONE = """
y dial «(617) 555-01XX» for the front desk
y My phone is «503-555-01XX» these days.
y Tel: «0711 555 03XX», abends
y fax to «(808) 555-0119» please
y her mobile, «917.555.01XX», is off
y call «0033 155 50143XX» from Spain
n Invoice «617-555-0173» was paid.
n Model «503.555.0188» is quieter.
n Ticket «808 555 0119» was merged.
n Sheet «155-501-4388» is missing.
n Part «917.555.0142» does not fit.
n The code «711-555-0362» expired.
""".strip()
